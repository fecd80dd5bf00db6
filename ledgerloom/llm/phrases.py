"""Benchmark decontamination by a distributed positional inverted index, in DataFrame functions only.

Words are maximal runs of digits, letters and characters beyond ASCII, A-Z lower-cased. The searched items are cut into
windows. First all training words that are terms of some window are counted; a window with a term that never
occurs is out. Then the posting lists (term, document, position) of each window's rarest terms are written as a table
with the length of every document. A window's lists are intersected from its rarest term on: positions are
shifted by the term's place in the window, so equal shifted positions are a possible start. What remains is compared
word by word with its document, which makes phrase matches exact at any number of lists. Proximity matches take
all terms of an item: postings of its rarest term meet the other terms' postings in buckets of nearby positions.

Term and window tables are broadcast only after they were counted to be small. Documents are named by (doc_id,
digest of the text), so rows that repeat an id keep their own results and equal rows share one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import BROADCAST_ROWS, cut_lineage, small_side

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Stands in the index for a document's end: its position is the document's number of words. No word holds a blank.
END = " "
# Posting lists intersected for a window before its words are compared.
LISTS = 2

DOC = ["doc_id", "digest"]


def lowered(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """The words of ``text`` in order; NULL has none."""
    pieces = F.split(F.coalesce(lowered(text), F.lit("")), BREAK)
    return F.filter(pieces, lambda x: x != "")


def _named(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("digest"), text.alias("text"))


def _tokens(named: DataFrame) -> DataFrame:
    """(doc_id, digest, key, term, pos) for each word, and one row with the term END for each document.

    ``key`` is a hash of the term: joins and counts go by that number, which is much faster, and compare the term after.
    """
    # a text that starts or ends with a break has an empty piece there
    cut = named.select(*DOC, F.split(lowered(F.col("text")), BREAK).alias("pieces"))
    last = F.element_at("pieces", -1) == ""
    lead = ((F.col("pieces")[0] == "") & (F.size("pieces") > 1)).cast("int")
    cut = cut.select(*DOC, lead.alias("lead"), last.cast("int").alias("trail"), F.array_append("pieces", F.lit(END)).alias("pieces"))
    rows = cut.select(*DOC, "lead", "trail", F.posexplode("pieces").alias("at", "term")).filter("term <> ''")
    pos = F.col("at") - F.col("lead") - F.when(F.col("term") == END, F.col("trail")).otherwise(0)
    return rows.select(*DOC, _key("term"), "term", pos.alias("pos"))


def _key(term: str) -> Column:
    return F.xxhash64(term).alias("key")


def _looked_up(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join whose right side is written, counted, and broadcast only if it is small."""
    side, rows = small_side(right)
    return left.join(F.broadcast(side) if rows <= BROADCAST_ROWS else side, on, how)


def _by_document(left: DataFrame, right: DataFrame, how: str, *more: str) -> DataFrame:
    """Rows of the same document (and ``more``), where NULL ids are equal; columns of the left side win."""
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*DOC, *more]]
    met = left.alias("l").join(right.alias("r"), same, how)
    if how == "left_semi":
        return met
    return met.select("l.*", *[f"r.{c}" for c in right.columns if c not in (*DOC, *more)])


def _windows(items: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Different windows of ``length`` words, shorter items being one (window, words), and (window, item_id)."""
    own = items.select("item_id", words(F.col("text").cast("string")).alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - length + 1, F.lit(1)))
    each = own.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, length))).alias("words"))
    each = cut_lineage(each.distinct())
    windows = cut_lineage(each.select("words").distinct().withColumn("window", F.monotonically_increasing_id()))
    return windows, cut_lineage(each.join(windows, "words").select("window", "item_id"))


class PhraseIndex:
    """Posting lists of the terms that decide about a set of items, over all ``docs`` (doc_id, text).

    ``items``: item_id, text. ``length``: words of a window. Other columns are ignored. NULL and empty texts have no
    words; items without words match nothing, and a NULL item id marks hits but is in no list of items.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, length: int = 10, lists: int = LISTS):
        self.length = length
        self.docs = _named(docs)
        self.windows, self.items = _windows(items, length)
        places = self.windows.select("window", F.size("words").alias("n"), F.posexplode("words").alias("offset", "term"))
        counts = self._counts(places.select("term").distinct().select(_key("term"), "term"))
        order = Window.partitionBy("window").orderBy("rows", "term", "offset")
        known = _looked_up(places, counts, ["term"]).withColumn("found", F.count(F.lit(1)).over(Window.partitionBy("window")))
        ranked = known.filter("found = n").withColumn("list", F.row_number().over(order) - 1).filter(F.col("list") < lists)
        self.slots = cut_lineage(ranked.select("window", "list", "term", "offset", "n"))
        self.lists = lists
        wanted = self.slots.select("term").distinct().unionAll(items.sparkSession.range(1).select(F.lit(END).alias("term")))
        found = _looked_up(_tokens(self.docs).withColumnRenamed("term", "found"), wanted.select(_key("term"), "term"), ["key"])
        self.postings = cut_lineage(found.filter("term = found").select(*DOC, "term", "pos"))

    def _counts(self, terms: DataFrame) -> DataFrame:
        """How often each term stands in the documents; terms of one key, which hardly happens, share their sum.

        Counts only choose the lists, and a term that is counted too often costs a list that the texts then refuse.
        """
        terms = cut_lineage(terms)
        words_ = _tokens(self.docs).select("key", F.col("term").alias("found"))
        same = _looked_up(words_, terms, ["key"]).filter("term = found")
        by_key = cut_lineage(same.groupBy("key").agg(F.count(F.lit(1)).alias("rows")))
        return terms.join(by_key, "key").select("term", "rows")

    def lengths(self) -> DataFrame:
        """doc_id, digest and n_words of every document row."""
        return self.postings.filter(F.col("term") == END).select(*DOC, F.col("pos").cast("long").alias("n_words"))

    def _starts(self) -> DataFrame:
        """(window, document, start) that the intersected lists allow."""
        postings = self.postings.filter(F.col("term") != END)
        found = None
        for k in range(self.lists):
            own = self.slots.filter(F.col("list") == k).select("window", "term", "offset")
            if found is None:
                met = _looked_up(postings, own, ["term"])
                found = met.select("window", *DOC, (F.col("pos") - F.col("offset")).alias("start")).filter("start >= 0")
                found = cut_lineage(found.distinct())
                continue
            last = self.slots.groupBy("window").agg(F.max("list").alias("last")).filter(F.col("last") < k)
            done = _looked_up(found, last.select("window"), ["window"], "left_semi")
            asked = _looked_up(found, own, ["window"]).withColumn("pos", F.col("start") + F.col("offset"))
            listed = _looked_up(postings, own.select("term").distinct(), ["term"], "left_semi")
            met = _by_document(asked, listed, "left_semi", "term", "pos").select(found.columns)
            found = cut_lineage(met.unionAll(done.select(found.columns)))
        return found

    def phrases(self) -> DataFrame:
        """Exact occurrences, one row a document: doc_id, digest, spans (array of start, n, window), by start."""
        allowed = _looked_up(self._starts(), self.windows, ["window"])
        asked = F.collect_list(F.struct("start", F.size("words").alias("n"), "window", "words")).alias("asked")
        each = cut_lineage(allowed.groupBy(*DOC).agg(asked))
        named, rows = small_side(each.select(*DOC))
        held = _by_document(self.docs, F.broadcast(named), "left_semi") if rows <= BROADCAST_ROWS else self.docs
        # the generator keeps the words from being cut anew for each place that is looked at
        texts = _by_document(held, each, "inner").select(*DOC, F.explode(F.array(words(F.col("text")))).alias("own"), "asked")
        true = F.filter("asked", lambda x: F.slice("own", x["start"] + 1, x["n"]) == x["words"])
        spans = F.transform(true, lambda x: F.struct(x["start"].alias("start"), x["n"].alias("n"), x["window"].alias("window")))
        return texts.select(*DOC, F.array_sort(spans).alias("spans")).filter("size(spans) > 0").dropDuplicates(DOC)

    def near(self, span: int) -> DataFrame:
        """Places where all different terms of a window stand within ``span`` words.

        One row for each occurrence of the window's rarest term that such a place holds: doc_id, digest, window,
        start, n (the shortest place around the occurrence, leftmost on ties). ``lists`` must be ``length`` or more, so
        that the index holds every term of a window.
        """
        if self.lists < self.length:
            raise ValueError("proximity needs an index with a list for each term")
        terms = self.slots.groupBy("window", "term").agg(F.min("list").alias("list"))
        rank = F.row_number().over(Window.partitionBy("window").orderBy("list"))
        terms = terms.select("window", "term", rank.alias("rank"), F.count(F.lit(1)).over(Window.partitionBy("window")).alias("kept"))
        bucket = F.floor(F.col("pos") / span)
        hits = cut_lineage(_looked_up(self.postings.filter(F.col("term") != END).distinct(), terms, ["term"]))
        buckets = F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket")
        pivots = hits.filter("rank = 1").select(*DOC, "window", "kept", F.col("pos").alias("pivot"), buckets)
        others = hits.select(*DOC, "window", "term", "pos", bucket.alias("bucket"))
        met = _by_document(pivots, others, "inner", "window", "bucket").filter(F.abs(F.col("pos") - F.col("pivot")) < span)
        around = met.groupBy(*DOC, "window", "pivot", "kept").agg(F.collect_set(F.struct("pos", "term")).alias("around"))
        around = around.withColumn("terms", F.array_distinct(F.transform("around", lambda x: x["term"])))
        around = around.filter(F.size("terms") == F.col("kept"))

        def place(left: Column) -> Column:
            def first(term: Column) -> Column:
                own = F.filter("around", lambda x: (x["term"] == term) & (x["pos"] >= left["pos"]))
                return F.array_min(F.transform(own, lambda x: x["pos"]))

            firsts = F.transform("terms", first)
            n = F.greatest(F.array_max(firsts), F.col("pivot")) - left["pos"] + 1
            whole = ~F.exists(firsts, lambda x: x.isNull()) & (n <= span)
            return F.when(whole, F.struct(n.alias("n"), left["pos"].alias("start")))

        places = F.transform(F.filter("around", lambda x: x["pos"] <= F.col("pivot")), place)
        best = around.withColumn("best", F.array_min(F.filter(places, lambda x: x.isNotNull())))
        return best.filter("best is not null").select(*DOC, "window", "best.start", "best.n")


def contaminated(docs: DataFrame, items: DataFrame, length: int = 10, lists: int = LISTS) -> DataFrame:
    """Which words of which documents stand in a window of ``length`` words of some item.

    One row for each row of ``docs``: doc_id, n_words, n_hit (words inside any occurrence), n_items and items (the
    different ids of items with an occurring window, as texts in order), spans (start and n of each occurrence). NULL and
    empty texts have no words; equal rows have equal results; empty tables give no rows or no hits.
    """
    index = PhraseIndex(docs, items, length, lists)
    hits = cut_lineage(index.phrases())
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["start"] + x["n"] - F.greatest(acc["end"], x["start"]))).alias("n"),
            F.greatest(acc["end"], x["start"] + x["n"]).alias("end"),
        ),
    )
    spans = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["n"].alias("n")))
    rows = hits.select(*DOC, covered["n"].cast("long").alias("n_hit"), F.array_distinct(spans).alias("spans"))
    windows = hits.select(*DOC, F.explode(F.array_distinct(F.transform("spans", lambda x: x["window"]))).alias("window"))
    named = _looked_up(windows, index.items.filter("item_id is not null"), ["window"])
    listed = named.groupBy(*DOC).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    every = _by_document(index.lengths(), _by_document(rows, listed, "left"), "left")
    none = F.array().cast("array<string>")
    return every.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,n:int>>")).alias("spans"),
    )


def phrase_matches(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """Every exact occurrence of a window: doc_id, item_id, start, n. Rows with equal id and text share their rows."""
    index = PhraseIndex(docs, items, length)
    each = index.phrases().select("doc_id", F.explode("spans").alias("x")).select("doc_id", "x.start", "x.n", "x.window")
    return _looked_up(each, index.items, ["window"]).select("doc_id", "item_id", "start", "n")


def proximity_matches(docs: DataFrame, items: DataFrame, span: int, length: int = 10) -> DataFrame:
    """Places of at most ``span`` words with all different terms of a window: doc_id, item_id, start, n.

    A window is ``length`` consecutive words of an item, or all of a shorter one.
    """
    index = PhraseIndex(docs, items, length, lists=length)
    return _looked_up(index.near(span), index.items, ["window"]).select("doc_id", "item_id", "start", "n")
