"""Embedding near-duplicates by inverted lists and product quantisation.

Coarse centroids and the codebooks of the residual's subspaces are fitted on a bounded sample; every vector is
indexed. A vector lies in the list of its nearest centroid, as one code for each subspace and the length of what the
codes leave out. To find the vectors within a distance r (a cosine of 0.95 is 0.316 on the unit sphere), a vector
probes each list whose boundary with its own list is near enough: a neighbour in list j must cross the plane halfway
between both centroids. In a list, distances to the codes are summed from tables; the code error bounds how far
the true distance can lie, so no candidate within r is lost there. Candidates are ranked by their exact cosine.

A neighbour's distance to the plane and its partner's sum up to r at most, so one of both probes the other's list. Each
entry holds the lists it probes: a link that only one side finds counts for both ends.

Equal vectors are one entry with a weight. Lists are cut into cells of bounded size on both sides. A cell returns
weights and a spanning forest of its links, never the pairs of a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship_code, written
from ledgerloom.llm.components import components
from ledgerloom.llm.vectors import usable

SAMPLE = 16_384
LISTS = 256
SUBSPACES = 8
CODES = 256
ENTRIES = 2048
QUERIES = 16_384
# Share of r that a probe reaches across a boundary; from 0.5 on one of two neighbours always finds the other.
MARGIN = 0.6

VECTORS = "vec_id long, dim int, v binary"
INDEXED = "list int, salt int, role int, node long, weight long, code binary, error double, v binary, home int, probes binary"
FOUND = "node long, links long, label long"


def kmeans(points: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = points[rng.choice(len(points), k, replace=len(points) < k)].copy()
    for _ in range(rounds):
        near = _nearest(points, centres)
        counts = np.bincount(near, minlength=k)
        for d in range(points.shape[1]):
            total = np.bincount(near, points[:, d], k)
            centres[:, d] = np.where(counts > 0, total / np.maximum(counts, 1), centres[:, d])
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(1) / 2
    return np.concatenate([np.argmax(points[i : i + 4096] @ centres.T - half, 1) for i in range(0, len(points), 4096)])


def fit(points: np.ndarray, lists: int, subspaces: int, seed: int = 1) -> dict[str, np.ndarray]:
    """Coarse centroids and residual codebooks (dimension padded to a multiple of ``subspaces``)."""
    rng = np.random.default_rng(seed)
    coarse = kmeans(points, lists, 8, rng)
    rest = points - coarse[_nearest(points, coarse)]
    books = np.stack([kmeans(part, CODES, 8, rng) for part in np.split(rest, subspaces, axis=1)])
    return {"coarse": coarse, "books": books}


def _unit(flat: list[bytes], dim: int, width: int) -> np.ndarray:
    """Unit vectors in double precision, padded with zeros."""
    rows = np.frombuffer(b"".join(flat), np.float64).reshape(-1, dim)
    unit = np.zeros((len(rows), width))
    unit[:, :dim] = rows / np.sqrt((rows**2).sum(1))[:, None]
    return unit


def _flatten(batches):
    for batch in batches:
        rows, vectors = usable(batch.column("embedding"), zero=False)
        dims, flat = [None] * batch.num_rows, [None] * batch.num_rows
        for i, v in zip(rows.tolist(), vectors):
            dims[i], flat[i] = len(v), (v / np.abs(v).max()).tobytes()  # the square of a component must stay finite
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(flat, pa.binary())], names=["vec_id", "dim", "v"])


def _fit(dim: int, width: int):
    def run(batches):
        held = [x for batch in batches for x in batch.column("v").to_pylist()]
        model = fit(_unit(held, dim, width), LISTS, SUBSPACES)
        row = [[model["coarse"].tobytes()], [model["books"].tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in row], names=["coarse", "books"])

    return run


def _index(model, dim: int, width: int, reach: float):
    """An entry row for each vector in its list, a query row in each list it probes."""

    def run(batches):
        coarse, books = model.value["coarse"], model.value["books"]
        gaps = np.sqrt(np.maximum(((coarse[:, None] - coarse[None]) ** 2).sum(2), 0))
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(batch.column("v").to_pylist(), dim, width)
            apart = (unit**2).sum(1)[:, None] - 2 * unit @ coarse.T + (coarse**2).sum(1)
            home = np.argmin(apart, 1)
            rest = unit - coarse[home]
            codes = np.stack([_nearest(part, book) for part, book in zip(np.split(rest, len(books), axis=1), books)], 1)
            guess = np.concatenate([book[codes[:, j]] for j, book in enumerate(books)], 1)
            error = np.sqrt(((rest - guess) ** 2).sum(1))
            nodes, weights = batch.column("node"), batch.column("weight")
            raw = batch.column("v")
            n = batch.num_rows
            probe = apart - apart[np.arange(n), home][:, None] <= 2 * MARGIN * reach * gaps[home] + 1e-9
            who, where = np.nonzero(probe)
            probes = pa.array([x.tobytes() for x in np.packbits(probe, axis=1)], pa.binary())
            code = pa.array([x.tobytes() for x in codes.astype(np.uint8)], pa.binary())
            columns = [
                pa.array(np.concatenate([home, where]).astype(np.int32)),
                pa.array(np.repeat([0, 1], [n, len(who)]).astype(np.int32)),
                pa.concat_arrays([nodes, nodes.take(pa.array(who))]),
                pa.concat_arrays([weights, weights.take(pa.array(who))]),
                pa.concat_arrays([code, pa.array([b""] * len(who), pa.binary())]),
                pa.array(np.concatenate([error, np.zeros(len(who))])),
                pa.concat_arrays([raw, raw.take(pa.array(who))]),
                pa.array(np.concatenate([home, home[who]]).astype(np.int32)),
                pa.concat_arrays([probes, pa.array([b""] * len(who), pa.binary())]),
            ]
            for i in range(0, n + len(who), 8192):
                yield pa.RecordBatch.from_arrays([c.slice(i, 8192) for c in columns], names=["list", "role", "node", "weight", "code", "error", "v", "home", "probes"])

    return run


def _forest(left: np.ndarray, right: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, label): nodes of the links (left[rows], right[cols]) with the smallest node of their cell component."""
    names, place = np.unique(np.concatenate([left[rows], right[cols]]), return_inverse=True)
    a, b = np.concatenate([place[: len(rows)], place[len(rows) :]]), np.concatenate([place[len(rows) :], place[: len(rows)]])
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    label = np.arange(len(names))
    while True:
        low = np.minimum(label, np.minimum.reduceat(label[b], starts))
        low = low[low]
        if (low == label).all():
            return names, names[label]
        label = low


def _cells(model, dim: int, width: int, cosine: float, reach: float):
    def run(batches):
        coarse, books = model.value["coarse"], model.value["books"]
        key, entry, kept = None, None, []
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            name = rows["list"].to_numpy().astype(np.int64) << 40 | rows["salt"].to_numpy()
            role = rows["role"].to_numpy()
            cuts = np.flatnonzero((name[1:] != name[:-1]) | (role[1:] != role[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(name)]):
                if b == a:
                    continue
                part = rows.slice(a, b - a)
                if name[a] != key:
                    key, entry, kept = name[a], None, []
                if role[a] == 0:
                    kept.append(part)
                    entry = None
                    continue
                if not kept:
                    continue
                if entry is None:
                    own = pa.concat_tables(kept)
                    codes = np.frombuffer(b"".join(own["code"].to_pylist()), np.uint8).reshape(own.num_rows, -1)
                    entry = (own["node"].to_numpy(), own["weight"].to_numpy(), codes, own["error"].to_numpy(),
                             _unit(own["v"].to_pylist(), dim, width),
                             np.unpackbits(np.frombuffer(b"".join(own["probes"].to_pylist()), np.uint8).reshape(own.num_rows, -1), axis=1))
                for i in range(0, part.num_rows, 512):
                    yield from _meet(part.slice(i, 512), entry, coarse[key >> 40], books, dim, width, cosine, reach)

    return run


def _meet(asked, entry, centre, books, dim, width, cosine, reach):
    nodes, weights, codes, error, exact, probes = entry
    home, own_weights = asked["home"].to_numpy(), asked["weight"].to_numpy()
    names, unit = asked["node"].to_numpy(), _unit(asked["v"].to_pylist(), dim, width)
    rest = unit - centre
    total = np.zeros((len(names), len(nodes)), np.float32)
    for j, (part, book) in enumerate(zip(np.split(rest, len(books), axis=1), books)):
        tables = (part**2).sum(1)[:, None] - 2 * part @ book.T + (book**2).sum(1)
        total += tables.astype(np.float32)[:, codes[:, j]]
    rows, cols = np.nonzero(total <= ((reach + error) ** 2 + 1e-4).astype(np.float32))
    other = names[rows] != nodes[cols]
    rows, cols = rows[other], cols[other]
    near = np.zeros(len(rows), bool)
    for i in range(0, len(rows), 65_536):
        own = slice(i, i + 65_536)
        near[own] = (unit[rows[own]] * exact[cols[own]]).sum(1) >= cosine
    rows, cols = rows[near], cols[near]
    if len(rows):
        links = np.bincount(rows, weights[cols], len(names)).astype(np.int64)
        hit = np.flatnonzero(links)
        member, label = _forest(names, nodes, rows, cols)
        # an entry that does not probe the asking vector's list does not find it there
        missed = probes[cols, home[rows]] == 0
        back = np.bincount(cols[missed], own_weights[rows[missed]], len(nodes)).astype(np.int64)
        far = np.flatnonzero(back)
        columns = [np.concatenate([names[hit], nodes[far], member]), np.concatenate([links[hit], back[far], np.zeros(len(member), np.int64)]),
                   np.concatenate([names[hit], nodes[far], label])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "links", "label"])


def near_duplicates(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """Vectors linked by a cosine of at least ``cosine``: vec_id, n_links, component_id, kept, one row a vector.

    Vectors (vec_id, embedding; other columns are ignored) that are NULL, empty, zero or hold NULL or non-finite
    components link with nothing. n_links counts the other rows linked directly; component_id is the smallest
    vec_id reachable, kept is vec_id = component_id. Rows with a NULL id link like others but name no component:
    alone, theirs is NULL. Rows with equal ids and other vectors count as one vector for each. Vectors of
    different dimensions never link. Every vector is indexed; only centroids and codebooks come from a sample.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    every = written(rows.mapInArrow(_flatten, VECTORS))
    flat = every.filter("dim is not null")
    classes = written(
        flat.groupBy("dim", "v").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight"))
        .withColumn("node", F.xxhash64("dim", "v"))
    )
    found = [_found(classes.filter(F.col("dim") == d["dim"]), d["dim"], cosine) for d in classes.select("dim").distinct().collect()]
    seen = found[0] if found else spark.createDataFrame([], FOUND)
    for more in found[1:]:
        seen = seen.union(more)
    seen = written(seen)
    labels = components(seen.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")).distinct())
    direct = seen.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    known = named.join(lowest, "component").join(direct, "node", "left").select(
        "dim", "v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), "component_id"
    )
    linked = flat.join(known, ["dim", "v"]).select("vec_id", "links", "component_id")
    alone = every.filter("dim is null")
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).select("vec_id", F.col("links").alias("n_links"), "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


def _found(classes: DataFrame, dim: int, cosine: float) -> DataFrame:
    spark = classes.sparkSession
    width = -(-dim // SUBSPACES) * SUBSPACES
    reach = float(np.sqrt(2 - 2 * cosine))
    # a bounded sample, spread by hash, fits the quantisers in one task
    sample = classes.orderBy("node").limit(SAMPLE).select("v").coalesce(1)
    fitted = sample.mapInArrow(_fit(dim, width), "coarse binary, books binary").first()
    model = spark.sparkContext.broadcast({
        "coarse": np.frombuffer(fitted["coarse"], np.float64).reshape(-1, width),
        "books": np.frombuffer(fitted["books"], np.float64).reshape(SUBSPACES, CODES, -1),
    })
    raw = "list int, role int, node long, weight long, code binary, error double, v binary, home int, probes binary"
    indexed = written(classes.select("node", "weight", "v").mapInArrow(_index(model, dim, width, reach), raw))
    # one row a list: how many cells it is cut into on either side
    sizes = indexed.groupBy("list").agg(
        F.ceil(F.sum(1 - F.col("role")) / ENTRIES).cast("int").alias("across"), F.ceil(F.sum("role") / QUERIES).cast("int").alias("down")
    )
    cut = indexed.join(F.broadcast(sizes), "list").filter("across > 0 and down > 0")
    entry = F.col("role") == 0
    place = F.pmod(F.xxhash64("node"), F.when(entry, F.col("across")).otherwise(F.col("down"))).cast("int")
    met = F.explode(F.sequence(F.lit(0), F.when(entry, F.col("down")).otherwise(F.col("across")) - 1))
    cells = cut.withColumn("place", place).withColumn("met", met)
    salt = F.when(entry, F.col("place") * F.col("down") + F.col("met")).otherwise(F.col("met") * F.col("down") + F.col("place"))
    cells = cells.withColumn("salt", salt.cast("int")).select(*[x.split()[0] for x in INDEXED.split(", ")])
    dealt = cells.repartition(F.col("list"), F.col("salt")).sortWithinPartitions("list", "salt", "role")
    return dealt.mapInArrow(_cells(model, dim, width, cosine, reach), FOUND)
