"""Near-duplicate documents: MinHash signatures joined through an inverted index of their coordinates.

Each distinct shingle set gets one signature of `COORDINATES` minima. The index posts a set under every
(coordinate, value) pair; two sets are compared if they collide under at least `MATCHES` of the pairs. Pairs are found by
merging only a prefix of each set's posting lists, the rarest ones first: of `c` lists that are shared with anyone, the
first `c - MATCHES + 1` must hold a common one. The long lists behind the prefix are skipped; for the candidates they are
looked up in the signatures. What passes is confirmed on the full sets.

A set at similarity 0.8 collides under 51 of 64 coordinates on average (standard deviation 3.2); 36 are asked for, so a link
is missed with a probability below 1e-5.

No list is expanded into its pairs. First every set is compared with one set of each of its lists, the one whose lists are
longest over all: in a group of copies that is the text nearest to all others. The links found join most of a group into one
component. Lists that then still hold several components are settled exactly: their sets are joined on a prefix of
the shingles themselves, so that the result is that of comparing all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import row_print, slices, stored, typed
from siltstone.llm.graph import components
from siltstone.llm.words import hash_words, mix, split_words, window_hashes

SHINGLE_WORDS = 5
SIMILARITY = 80  # per cent
COORDINATES = 64
MATCHES = 36


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """For each text its distinct word shingles as sorted hashes; a text of fewer words is one shingle, one without words none."""
    words, offsets = split_words(texts, lower=True)
    hashes = hash_words(words)
    counts = np.diff(offsets)
    windows = window_hashes(hashes, width)
    sets = []
    for start, count in zip(offsets[:-1].tolist(), counts.tolist()):
        if count >= width:
            sets.append(np.unique(windows[start:start + count - width + 1]))
        elif count:
            sets.append(window_hashes(hashes[start:start + count], count))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _sign(width: int, coordinates: int):
    seeds = mix(np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
    factors = mix(seeds) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column(0), width)
                sizes = np.array([len(s) for s in sets], np.int64)
                held = np.flatnonzero(sizes)
                signature = np.zeros((len(held), coordinates), np.uint64)
                prints = np.zeros((len(sets), 2), np.uint64)
                if len(held):
                    whole = np.concatenate([sets[i] for i in held])
                    starts = np.concatenate(([0], np.cumsum(sizes[held])[:-1]))
                    for k in range(coordinates):
                        low = np.minimum.reduceat((whole ^ seeds[k]) * factors[k], starts)
                        signature[:, k] = mix(low ^ seeds[k])
                    for k in range(2):
                        prints[held, k] = np.add.reduceat(mix(whole ^ seeds[k]), starts)
                filled = np.zeros(len(sets) + 1, np.int32)
                filled[1:] = np.cumsum(np.where(sizes > 0, coordinates, 0))
                yield pa.RecordBatch.from_arrays([
                    part.column(1), part.column(2), pa.array(sizes),
                    pa.array([p.tobytes() for p in prints], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(filled), pa.array(signature.ravel().view(np.int64))),
                ], ["doc_id", "text_print", "n_shingles", "set_print", "signature"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column(0), width)
                filled = np.zeros(len(sets) + 1, np.int32)
                filled[1:] = np.cumsum([len(s) for s in sets])
                values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.ListArray.from_arrays(pa.array(filled), pa.array(values.view(np.int64)))],
                    ["node", "shingles"])

    return run


def _colliding(pairs: DataFrame, classes: DataFrame, matches: int, similarity: int) -> DataFrame:
    """The pairs (a, b) with sizes near enough and at least `matches` equal coordinates."""
    side = lambda name: classes.select(
        F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("signature").alias(f"s_{name}"))
    equal = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda x, y: x + y)
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where(100 * F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b")).where(equal >= matches)
    return stored(both.select("a", "b", "n_a", "n_b"), "candidates", small=True)


def _shingles_of(nodes: DataFrame, classes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(node, shingles) with the full sets of the given nodes, taken from one text of each."""
    wanted = nodes.distinct().join(classes.select("node", "row.doc_id", "row.text_print"), "node")
    held = texts.join(wanted, texts.doc_id.eqNullSafe(wanted.doc_id) & (texts.text_print == wanted.text_print))
    sets = held.select("text", "node").mapInArrow(_sets(width), "node bigint, shingles array<bigint>")
    return stored(sets.dropDuplicates(["node"]), "shingles")


def _links(close: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    one = lambda name: sets.select(F.col("node").alias(name), F.col("shingles").alias(f"s_{name}"))
    both = close.join(one("a"), "a").join(one("b"), "b").withColumn("common", F.size(F.array_intersect("s_a", "s_b")).cast("long"))
    alike = 100 * F.col("common") >= similarity * (F.col("n_a") + F.col("n_b") - F.col("common"))
    return stored(both.where(alike).select("a", "b"), "links", small=True)


def _size_class(n: Column) -> Column:
    """Sizes up to 50 apart, larger ones in classes 2 per cent wide."""
    return F.when(n <= 50, n).otherwise(50 + F.floor(F.log(n / 50.0) / math.log(1.02))).cast("int")


def _least_of_class(k: Column) -> Column:
    """A size that no member of the class is below."""
    return F.when(k <= 50, k).otherwise(F.ceil(50 * F.pow(F.lit(1.02), k - 50) - 1e-6)).cast("long")


def _facing(posts: DataFrame, on: list[str], also: Column) -> DataFrame:
    """Pairs (a, b) of rows of different components, each in the other's class of size, equal in `on`.

    Rows have node, component, own, other, hub, free. Components meet before their members do.
    """
    keys = [*on, "own", "other"]
    unit = ["component", "hub", "free"]
    there = [F.col("component").alias("component_y"), F.col("hub").alias("hub_y"), F.col("free").alias("free_y")]
    mirror = posts.select(*on, F.col("other").alias("own"), F.col("own").alias("other"), *there, F.col("node").alias("y"))
    parts = posts.select(*keys, *unit).distinct().join(
        mirror.select(*keys, "component_y", "hub_y", "free_y").distinct(), keys).where("component < component_y").where(also)
    pairs = parts.join(posts, [*keys, *unit]).join(mirror, [*keys, "component_y", "hub_y", "free_y"])
    return pairs.select(F.greatest("node", "y").alias("a"), F.least("node", "y").alias("b"))


def _split_by_component(rows: DataFrame, on: list[str]) -> DataFrame:
    """The rows of keys `on` that more than one component has."""
    spread = rows.groupBy(*on).agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return rows.join(spread.select(*on), on)


def _across(left: DataFrame, hubs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) of nodes from different components of `left` (post, node, component) that may be links.

    With s per cent, a link of sizes n_a and n_b needs o = s * (n_a + n_b) / (100 + s) common shingles, all of them among
    those that several components have. Of the `u` such shingles of a set, rarest first, the first u - o + 1 must hold a
    common one. How many that is depends on the other's size, so sets meet by class of size.

    Sets near the same hub have most shingles in common with it, rare ones too; what tells them apart lies outside it. A set
    with `c` shingles of its hub shares at most those inside it with another, so t = o - c of the common ones are outside: of
    its `p` outer shingles that several components have, the first p - t + 1 must hold one. Only two sets that both have c >= o
    need no outer one in common; these meet as sets of different hubs do, with rarity counted among the hub's sets of that kind.
    """
    owners = left.select("node", "component").distinct()
    near = left.join(hubs, "post").groupBy("node").agg(F.max(F.struct("weight", "hub")).alias("h")).select("node", "h.hub")
    own = sets.select("node", F.size("shingles").cast("long").alias("n"), "shingles").join(owners, "node").join(near, "node")
    spread = own.select("node", "component", F.explode("shingles").alias("shingle"))
    common = spread.groupBy("shingle").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("held")).where("low < high")
    ranked = spread.join(common.select("shingle", "held"), "shingle").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("ranked"))
    ranked = own.join(ranked, "node").where(100 * F.size("ranked") >= similarity * F.col("n"))
    core = sets.select(F.col("node").alias("hub"), F.col("shingles").alias("core"))
    ranked = stored(ranked.join(core, "hub").select(
        "node", "component", "hub", "n", "ranked", F.size(F.array_intersect("shingles", "core")).cast("long").alias("c"),
        F.array_except("shingles", "core").alias("outer")), "ranked")

    least, most = F.ceil(similarity * F.col("n") / 100).cast("long"), F.floor(100 * F.col("n") / similarity).cast("long")

    def partners(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("own", _size_class(F.col("n"))).withColumn(
            "other", F.explode(F.sequence(_size_class(least), _size_class(most))))
        smallest = F.greatest(_least_of_class(F.col("other")), least)
        return rows.withColumn("o", F.ceil(similarity * (F.col("n") + smallest) / (100 + similarity)).cast("int"))

    def prefixes(rows: DataFrame, values: str, first: Column, label: str) -> DataFrame:
        rows = rows.withColumn("first", first).where("first > 0")
        return stored(rows.select("node", "component", "own", "other", "hub", "free", F.explode(F.slice(values, F.lit(1), F.col("first"))).alias("p"))
                      .select("node", "component", "own", "other", "hub", "free", "p.shingle"), label)

    several = left.join(near, "node").groupBy("post").agg(F.min("hub").alias("low"), F.max("hub").alias("high")).where("low < high")
    several = left.join(several.select("post"), "post").select("node").distinct()
    apart = partners(ranked.join(several, "node")).withColumn("free", F.lit(False))
    apart = prefixes(apart, "ranked", F.size("ranked") - F.col("o") + 1, "apart")
    found = _facing(apart, ["shingle"], F.col("hub") != F.col("hub_y"))

    outside = ranked.select("node", "component", "hub", F.explode("outer").alias("shingle"))
    common = outside.groupBy("hub", "shingle").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("held")).where("low < high")
    outer = outside.join(common.select("hub", "shingle", "held"), ["hub", "shingle"]).groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("outer"))
    rows = partners(ranked.select("node", "component", "hub", "n", "c")).withColumn("free", F.col("o") <= F.col("c"))
    first = F.when(F.col("free"), F.size("outer")).otherwise(F.size("outer") - (F.col("o") - F.col("c")) + 1).cast("int")
    beside = prefixes(rows.join(outer, "node"), "outer", first, "beside")
    same = F.col("hub") == F.col("hub_y")
    found = found.union(_facing(beside, ["shingle"], same & ~(F.col("free") & F.col("free_y"))))
    free = rows.where("free")
    within = ranked.join(free.select("node").distinct(), "node").select("node", "component", "hub", F.explode("ranked.shingle").alias("shingle"))
    common = within.groupBy("hub", "shingle").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("held")).where("low < high")
    inner = within.join(common.select("hub", "shingle", "held"), ["hub", "shingle"]).groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("inner"))
    inner = prefixes(free.join(inner, "node"), "inner", F.size("inner") - F.col("o") + 1, "inner").withColumn("group", F.col("hub"))
    return found.union(_facing(inner, ["group", "shingle"], same)).distinct()


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE_WORDS, similarity: int = SIMILARITY,
    coordinates: int = COORDINATES, matches: int = MATCHES,
) -> DataFrame:
    """For each row of `docs` (doc_id, text, anything else): doc_id, text_print, n_shingles, component_id, kept, n_links.

    Sets of word shingles are linked at `similarity` per cent or more; `component_id` is the smallest doc_id that a row
    reaches, `kept` marks the row that bears it. `n_links` counts the different sets that a row's set was found to be
    linked with (links that only confirm a component already joined are not looked for).

    A text that is null or has no words has no shingles and is linked with nothing. A null doc_id: the row takes part in
    links, but gives no name to its component unless there is no other; then component_id is null and the row is kept.
    Repeated rows get equal results. Other columns are left out; an empty table gives an empty result.
    """
    texts = docs.select("doc_id", "text", row_print(F.col("text")).alias("text_print"))
    kind = docs.schema["doc_id"].dataType
    signed = stored(
        texts.select("text", "doc_id", "text_print").mapInArrow(
            _sign(width, coordinates),
            typed(doc_id=kind, text_print="bigint", n_shingles="bigint", set_print="binary", signature="array<bigint>")), "signatures")
    rows = signed.where("n_shingles > 0")
    classes = stored(
        rows.groupBy("set_print").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "text_print")).alias("row"),
            F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")

    posts = classes.select("node", F.explode("signature").alias("post"))
    shared = posts.groupBy("post").agg(F.count("*").alias("n")).where("n > 1")
    lists = posts.join(shared, "post").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("n", "post"))).alias("posts"), F.sum("n").alias("weight"))
    prefix = stored(
        lists.where(F.size("posts") >= matches)
        .select("node", "weight", F.explode(F.slice("posts", F.lit(1), F.size("posts") - (matches - 1))).alias("p"))
        .select("node", "weight", "p.post"), "prefixes")
    hubs = prefix.groupBy("post").agg(F.max(F.struct("weight", "node")).alias("hub")).select(
        "post", "hub.weight", F.col("hub.node").alias("hub"))
    pairs = stored(
        prefix.join(hubs, "post").where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), "pairs", small=True)
    close = _colliding(pairs, classes, matches, similarity)
    sets = _shingles_of(close.select(F.col("a").alias("node")).union(close.select("b")), classes, texts, width)
    links = _links(close, sets, similarity)
    named = components(links)

    joined = prefix.join(named, "node", "left").select("post", "node", F.coalesce("component", "node").alias("component"))
    left = stored(_split_by_component(joined, ["post"]), "mixed", small=True)
    sets = _shingles_of(left.select("node"), classes, texts, width)
    tried = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rest = stored(_across(left, hubs, sets, similarity).join(tried, ["a", "b"], "left_anti"), "pairs", small=True)
    more = _links(_colliding(rest, classes, matches, similarity), sets, similarity)
    links = links.union(more)
    named = components(named.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count("*").alias("n_links"))

    nodes = (
        classes.select("set_print", "node", F.col("row.doc_id").alias("first_id"))
        .join(named, "node", "left").join(degree, "node", "left")
        .select("set_print", F.coalesce("component", "node").alias("component"), "first_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    nodes = stored(nodes, "nodes", small=True)
    names = nodes.groupBy("component").agg(F.min("first_id").alias("name"))
    found = nodes.join(names, "component").select("set_print", "name", "n_links")
    result = signed.select("doc_id", "text_print", "n_shingles", "set_print").join(found, "set_print", "left")
    name = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("name"))
    return result.select(
        "doc_id", "text_print", "n_shingles", name.alias("component_id"),
        F.coalesce(F.col("doc_id") == name, F.col("doc_id").isNull() & name.isNull()).alias("kept"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """`docs` with one row of each group of near duplicates, its columns unchanged.

    Rows without words, and rows whose doc_id is null, stay. Of repeated rows one stays.
    """
    found = near_duplicates(docs, **options).where("kept").select("doc_id", "text_print").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("own_id"), row_print(F.col("text")).alias("own_print"))
    kept = rows.join(found, rows.own_id.eqNullSafe(found.doc_id) & (rows.own_print == found.text_print), "left_semi")
    return kept.select("row.*")
