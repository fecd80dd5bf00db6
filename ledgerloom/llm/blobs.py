"""Signatures dealt out by their leading bits in compact blobs.

A blob holds the entries of one bucket and some nodes: the nodes once, then for each entry six bytes of signature and a
two-byte place among the nodes. The bucket holds the signature's leading bits, so together over 48 of 64 bits
decide; two signatures taken for one only cost a candidate that exact counts refuse.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ledgerloom.llm.common import key_runs

BLOBS = "bucket int, nodes binary, at binary, sigs binary"


class Writer:
    """Gathers (node, signatures) and gives batches of blobs once enough are held."""

    def __init__(self, buckets: int, flush: int = 1_000_000):
        self.buckets, self.flush = buckets, flush
        self.nodes: list[int] = []
        self.keys: list[np.ndarray] = []
        self.held = 0

    def add(self, node: int, signatures: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(signatures):
            self.nodes.append(node)
            self.keys.append(signatures)
            self.held += len(signatures)
            if self.held >= self.flush or len(self.nodes) >= 60_000:
                yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if not self.nodes:
            return
        values = np.concatenate(self.keys)
        owner = np.repeat(np.arange(len(self.nodes), dtype=np.uint16), [len(x) for x in self.keys])
        bucket = ((values >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)
        order = np.argsort(bucket, kind="stable")
        values, owner = values[order], owner[order]
        low = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :6])
        cuts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        names = np.array(self.nodes, np.int64)
        out: list[tuple] = []
        for b in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[b], cuts[b + 1])
            used, place = np.unique(owner[own], return_inverse=True)
            out.append((int(b), names[used].tobytes(), place.astype(np.uint16).tobytes(), low[own].tobytes()))
        self.nodes, self.keys, self.held = [], [], 0
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=["bucket", "nodes", "at", "sigs"]
        )


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each bucket of a partition: its nodes in order, and signature groups as (owner, starts).

    ``owner`` lists places in the nodes, group after group, each node once a group and in order; ``starts`` are the
    groups' first entries.
    """
    for rows, cuts in key_runs(batches, ["bucket"]):
        for i in range(len(cuts) - 1):
            names, owners, sigs, base = [], [], [], 0
            for blob in rows.slice(cuts[i], cuts[i + 1] - cuts[i]).to_pylist():
                own = np.frombuffer(blob["nodes"], np.int64)
                names.append(own)
                owners.append(np.frombuffer(blob["at"], np.uint16).astype(np.int64) + base)
                raw = np.zeros((len(blob["at"]) // 2, 8), np.uint8)
                raw[:, :6] = np.frombuffer(blob["sigs"], np.uint8).reshape(-1, 6)
                sigs.append(raw.view(np.uint64).ravel())
                base += len(own)
            different, place = np.unique(np.concatenate(names), return_inverse=True)
            owner, sig = place[np.concatenate(owners)], np.concatenate(sigs)
            order = np.lexsort((owner, sig))
            sig, owner = sig[order], owner[order]
            keep = np.ones(len(sig), bool)
            keep[1:] = (sig[1:] != sig[:-1]) | (owner[1:] != owner[:-1])
            sig, owner = sig[keep], owner[keep]
            yield different, owner, np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
