"""Near-duplicate documents by an inverted join of MinHash coordinates.

1. Each text becomes its set of hashed word shingles; equal sets form a class, and only one
   row of a class goes on. A class has a signature of ``COORDINATES`` minima.
2. Classes are posted under every pair of coordinate and value. A pair of classes is a match if
   at least ``matches`` coordinates agree, so a value that no other class has can be skipped,
   a class with fewer than ``matches`` shared values has no match, and of the others only a
   prefix of their rarest values has to be merged: any match shares a value of both prefixes.
3. Prefix postings of up to ``SHORT`` classes are merged pair by pair: the pairs that share any
   are listed once each, their agreeing coordinates counted, and only matches are kept. A longer
   posting ties its classes to its smallest one instead. The connected components of matches and
   ties are clusters that hold every match; texts that share passages but don't match are in none.
4. Within a cluster agreeing coordinates are counted, matches are confirmed on the full sets
   and joined; pairs whose classes are joined already are skipped. Clusters over a bounded size
   are cut into blocks that all hold the cluster's first class. Classes that are then outside
   the cluster's largest group are compared with every other block, also in bounded shares,
   so no link is lost.

Match and prefix are exact for the signatures. ``matches`` lies five standard deviations below
what two sets at the limit agree in; the links themselves are decided on the sets. The limit is
the least Jaccard similarity in percent, ``PERCENT`` unless stated.

Case table: a null or word-free text has an empty set and is linked with nothing; fewer words
than a shingle are one shingle; rows with a null id are never linked; rows of one id are
compared like others; an empty table gives no row; extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depotlens.llm.components import components
from depotlens.llm.storage import fresh_folder, stored
from depotlens.llm.words import SPACED, coded, hashes, mixed, released, slices, split_words, unused

SHINGLE = 5
PERCENT = 85
COORDINATES = 64
BLOCK_CLASSES = 2000
SHORT = 16  # a longer posting is not merged pair by pair
SALTS = 16
BLOCK_SHINGLES = 2_000_000

_PLACES = mixed(np.arange(1, SHINGLE + 2, dtype=np.uint64)) | np.uint64(1)
_FACTORS = mixed(np.arange(101, 101 + COORDINATES, dtype=np.uint64)) | np.uint64(1)


def matches(percent: int) -> int:
    """Coordinates that must agree: five standard deviations below the mean at the limit."""
    share = percent / 100
    return max(1, int(COORDINATES * share - 5 * (COORDINATES * share * (1 - share)) ** 0.5))


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text end to end, and their numbers."""
    counts, values = split_words(texts, SPACED)
    codes, distinct = coded(values)
    if not len(distinct):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    words = hashes(distinct)[codes]
    ends = np.cumsum(counts)
    begins = np.repeat(ends - counts, counts)
    place = np.arange(len(words))
    left = np.repeat(ends, counts) - place
    size = np.minimum(np.repeat(counts, counts), SHINGLE)
    first = np.flatnonzero((left >= size) & ((size == SHINGLE) | (place == begins)))
    sums = size[first].astype(np.uint64) * _PLACES[SHINGLE]
    for k in range(SHINGLE):
        inside = size[first] > k
        sums[inside] += words[first[inside] + k] * _PLACES[k]
    found = mixed(sums)
    row = np.searchsorted(ends, first, side="right")
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    return found[new], np.bincount(row[new], minlength=len(texts))


def signatures(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Minima of ``COORDINATES`` permutations of each set that is not empty."""
    filled = counts > 0
    result = np.zeros((len(counts), COORDINATES), np.int64)
    if filled.any():
        starts = (np.cumsum(counts) - counts)[filled]
        for k, factor in enumerate(_FACTORS):
            result[filled, k] = (np.minimum.reduceat(sets * factor, starts) >> np.uint64(33)).astype(np.int64)
    return result


def _set_keys(sets: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent sums over each set: equal sets have equal keys."""
    before = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(sets ^ np.uint64(salt)))]) for salt in (0x5851F42D, 0x14057B7E)]
    ends = np.cumsum(counts)
    return tuple((total[ends] - total[ends - counts]).view(np.int64) for total in before)


@released
def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            sets, counts = shingle_sets(part.column("text"))
            one, two = _set_keys(sets, counts)
            flat = pa.array(signatures(sets, counts).ravel().astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * COORDINATES), flat)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(counts), pa.array(one), pa.array(two), lists],
                names=["doc_id", "text_hash", "n_shingles", "key1", "key2", "signature"],
            )


def _intersection(a: np.ndarray, b: np.ndarray) -> int:
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[place] == a).sum())


def _near(common: np.ndarray | int, a: int, b: np.ndarray | int, percent: int) -> np.ndarray | bool:
    return 100 * common >= percent * (a + b - common)


def linked(
    sets: list[np.ndarray], signs: np.ndarray, group: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int = PERCENT
) -> list[tuple[int, int]]:
    """Confirmed links between rows of ``left`` and rows of ``right`` that join all groups
    that such links join. ``group`` numbers the groups known so far and is updated.

    For each left row the agreeing coordinates with all right rows are counted; candidates
    are tried from the best on, and those joined meanwhile are skipped. After a few misses
    the rest is counted at once over the sorted shingles of all right rows."""
    sizes = np.array([len(s) for s in sets], np.int64)
    links, counted, least = [], None, matches(percent)

    def join(i: int, j: int) -> None:
        links.append((i, j))
        group[group == group[j]] = group[i]

    for i in left.tolist():
        agreeing = (signs[right] == signs[i]).sum(axis=1)
        close = 100 * np.minimum(sizes[right], sizes[i]) >= percent * np.maximum(sizes[right], sizes[i])
        found = np.flatnonzero((agreeing >= least) & close & (group[right] != group[i]))
        open_rows = right[found[np.argsort(-agreeing[found], kind="stable")]]
        misses = 0
        while len(open_rows):
            if misses == 8:
                counted = counted or _Counter([sets[j] for j in right.tolist()])
                common = np.zeros(len(sets), np.int64)
                common[right] = counted.common(sets[i])
                for j in open_rows[_near(common[open_rows], sizes[i], sizes[open_rows], percent)].tolist():
                    if group[i] != group[j]:
                        join(i, j)
                break
            j = int(open_rows[0])
            if _near(_intersection(sets[i], sets[j]), int(sizes[i]), int(sizes[j]), percent):
                join(i, j)
                open_rows = open_rows[group[open_rows] != group[i]]
            else:
                misses += 1
                open_rows = open_rows[1:]
    return links


class _Counter:
    """Sorted shingles of many sets, to count the common ones with a set at once."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner, self.rows = flat[order], owner[order], len(sets)

    def common(self, one: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(self.flat, one), np.searchsorted(self.flat, one, side="right")
        runs = high - low
        at = np.repeat(low - np.cumsum(runs) + runs, runs) + np.arange(int(runs.sum()))
        return np.bincount(self.owner[at], minlength=self.rows)


def _loaded(table: pa.Table) -> tuple[pa.Table, list[np.ndarray], np.ndarray]:
    """Rows of one block, each class once, with sets from their texts and signatures. A
    text that is not its class's (another row of the same id) is left out."""
    kept, sets = [], []
    for batch in table.to_batches():
        for part in slices(batch):
            flat, counts = shingle_sets(part.column("text"))
            one, two = _set_keys(flat, counts)
            same = (one == part.column("key1").to_numpy()) & (two == part.column("key2").to_numpy())
            pieces = np.split(flat, np.cumsum(counts)[:-1])
            rows = np.flatnonzero(same)
            kept.append(part.drop_columns(["text"]).take(pa.array(rows)))
            sets += [pieces[r] for r in rows]
    rows = pa.Table.from_batches(kept) if kept else table.drop_columns(["text"]).slice(0, 0)
    _, first = np.unique(rows["rep"].to_numpy(), return_index=True)
    rows = rows.take(pa.array(first))
    signs = rows["signature"].combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
    return rows, [sets[k] for k in first], signs


_LINKS = "a bigint, b bigint"
_GROUPS = "rep bigint, root bigint, low bigint, large boolean"


def _link_block(percent: int):
    """Groups joined by the links within one block, cluster by cluster: each class with the
    smallest class of its group, and the smallest document id of the group."""

    def run(table: pa.Table) -> pa.Table:
        rows, sets, signs = _loaded(table)
        reps, cluster = rows["rep"].to_numpy(), rows["cluster"].to_numpy()
        group = np.arange(len(reps))
        order = np.argsort(cluster, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
            for k in range(1, len(members)):
                linked(sets, signs, group, members[k : k + 1], members[:k], percent)
        _, number = np.unique(group, return_inverse=True)
        root, low = (np.full(len(reps), np.iinfo(np.int64).max) for _ in range(2))
        np.minimum.at(root, number, reps)
        np.minimum.at(low, number, rows["low"].to_numpy())
        large = pc.greater(rows["blocks"], 1).combine_chunks()
        return pa.table({"rep": pa.array(reps), "root": pa.array(root[number]), "low": pa.array(low[number]), "large": large})

    return run


def _link_guests(percent: int):
    """Links between the guests and the classes at home in one block, over their groups."""

    def run(table: pa.Table) -> pa.Table:
        rows, sets, signs = _loaded(table)
        reps, guest = rows["rep"].to_numpy(), rows["guest"].to_numpy(zero_copy_only=False)
        group = np.unique(rows["root"].to_numpy(), return_inverse=True)[1]
        links = linked(sets, signs, group, np.flatnonzero(guest), np.flatnonzero(~guest), percent)
        a, b = (np.array([pair[k] for pair in links], np.int64) for k in (0, 1))
        return pa.table({"a": pa.array(reps[a], pa.int64()), "b": pa.array(reps[b], pa.int64())})

    return run


def _clusters(classes: DataFrame, folder: str, percent: int) -> DataFrame:
    """Clusters of the classes that may have a match: ``rep`` and ``cluster``."""
    least = matches(percent)
    token = F.transform("signature", lambda v, k: k.cast("long") * F.lit(1 << 32) + v)
    posts = classes.select("rep", F.explode(token).alias("token"))
    shared = posts.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    posts = posts.join(shared, "token")
    mine = Window.partitionBy("rep")
    prefix = F.row_number().over(mine.orderBy("n", "token")) <= F.lit(COORDINATES - least + 1) - (F.lit(COORDINATES) - F.col("many"))
    posts = posts.withColumn("many", F.count("*").over(mine)).where(F.col("many") >= least)
    # n counts all classes of a value, so a posting of prefixes is no longer than that
    merged = stored(posts.withColumn("prefix", prefix).where("prefix").select("token", "rep", "n"), folder, "prefixes")
    long = merged.where(F.col("n") > SHORT)
    first = long.groupBy("token").agg(F.min("rep").alias("b"))
    ties = long.join(first, "token").where("rep <> b").select(F.col("rep").alias("a"), "b")
    pairs = matching_pairs(merged.where(F.col("n") <= SHORT), classes, least)
    tied = components(ties.unionAll(pairs.select("a", "b")), folder, "ties")
    return tied.select(F.col("node").alias("rep"), F.col("root").alias("cluster"))


def candidate_pairs(postings: DataFrame) -> DataFrame:
    """Pairs of classes that share a posting, each once, smaller first. A posting has at
    most ``SHORT`` classes."""
    listed = postings.groupBy("token").agg(F.sort_array(F.collect_list("rep")).alias("reps"))
    later = lambda k: F.slice("reps", k + 2, SHORT)
    pairs = F.flatten(F.transform("reps", lambda a, k: F.transform(later(k), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    found = listed.select(F.explode(pairs).alias("pair")).select("pair.*")
    # dealt by the smaller one, as the join that follows wants them
    return found.repartition("a").distinct()


def matching_pairs(postings: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """Candidate pairs that agree in at least ``least`` coordinates: ``a``, ``b``, ``agreeing``."""
    signs = classes.select("rep", "signature")
    one, two = (signs.select(F.col("rep").alias(x), F.col("signature").alias(f"sign_{x}")) for x in "ab")
    both = candidate_pairs(postings).join(one, "a").join(two, "b")
    agreeing = F.size(F.filter(F.zip_with("sign_a", "sign_b", lambda x, y: x == y), lambda same: same))
    return both.select("a", "b", agreeing.alias("agreeing")).where(F.col("agreeing") >= least)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def sketches(documents: DataFrame, folder: str) -> DataFrame:
    """Stored rows ``doc_id``, ``text_hash``, ``row``, set size, set keys and signature."""
    schema = "doc_id bigint, text_hash bigint, n_shingles bigint, key1 bigint, key2 bigint, signature array<int>"
    made = _texts(documents).mapInArrow(_sketch, schema)
    return stored(made.withColumn("row", F.monotonically_increasing_id()), folder, "sketches")


def near_groups(documents: DataFrame, classes: DataFrame, folder: str, block_classes: int = BLOCK_CLASSES, percent: int = PERCENT) -> DataFrame:
    """``rep`` and ``component``, the smallest document id of its component, for every
    class that has a cluster."""
    members = _clusters(classes, folder, percent).join(classes, "rep")
    members = stored(members, folder, "members")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    blocks = F.greatest(F.ceil(F.col("n") / block_classes), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("int")
    sizes = stored(sizes.select("cluster", "n", blocks.alias("blocks")), folder, "sizes")
    total = sizes.where("blocks = 1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bins = max(1, -(-total // block_classes))

    # small clusters share bins; a block of a large one is a bin of its own
    home = F.when(F.col("blocks") == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64("rep"), "blocks"))
    placed = members.join(sizes, "cluster").withColumn("block", home.cast("int"))
    every = F.when(F.col("rep") == F.col("cluster"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    name = F.when(F.col("blocks") == 1, -1 - F.pmod(F.xxhash64("cluster"), F.lit(bins))).otherwise(F.col("cluster"))
    wanted = placed.select(
        "doc_id", "text_hash", "rep", "low", "key1", "key2", "cluster", "blocks", "block", name.alias("bin"), F.explode(every).alias("at"), "signature"
    )
    # a text that is repeated under its id is met once
    texts = _texts(documents).dropDuplicates(["doc_id", "text_hash"])
    met = wanted.join(texts, ["doc_id", "text_hash"]).groupBy("bin", "at").applyInArrow(_link_block(percent), _GROUPS)
    groups = stored(met, folder, "groups")
    done = groups.where("not large").select("rep", F.col("low").alias("component"))
    if sizes.where("blocks > 1").isEmpty():
        return done
    return done.unionAll(_large_groups(stored(wanted.where("blocks > 1"), folder, "large"), texts, groups, folder, block_classes, percent))


def _large_groups(large: DataFrame, texts: DataFrame, groups: DataFrame, folder: str, block_classes: int, percent: int) -> DataFrame:
    """Components of the clusters of several blocks. Their blocks are tied by the first
    class of the cluster; what is then outside the cluster's largest group meets the other
    blocks as guests."""
    links = groups.where("large").select(F.col("rep").alias("a"), F.col("root").alias("b"))
    joined = components(links, folder, "blocks").withColumnRenamed("node", "rep")
    rooted = large.where("at = block").join(joined, "rep")
    parts = rooted.groupBy("cluster", "root").agg(F.count("*").alias("n"))
    main = parts.groupBy("cluster").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    rooted = stored(_salted(rooted, main, "cluster"), folder, "rooted")
    outside = rooted.where("root <> main")
    shares = outside.groupBy("cluster").agg(F.ceil(F.count("*") / block_classes).cast("int").alias("shares"))
    held = [c for c in rooted.columns if c not in ("at", "main")]
    others = F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("block")))
    share = F.pmod(F.xxhash64("rep", F.lit(1)), "shares").cast("int")
    guests = outside.join(shares, "cluster").select(*held, others.alias("at"), share.alias("share"), F.lit(True).alias("guest"))
    numbers = F.explode(F.sequence(F.lit(0), F.col("shares") - 1))
    hosts = rooted.join(shares, "cluster").select(*held, F.col("block").alias("at"), numbers.alias("share"), F.lit(False).alias("guest"))
    met = guests.unionAll(hosts).join(texts, ["doc_id", "text_hash"])
    more = stored(met.groupBy("cluster", "at", "share").applyInArrow(_link_guests(percent), _LINKS), folder, "guests")
    final = components(joined.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionAll(more), folder, "final")
    lows = rooted.select("rep", "low").join(final.withColumnRenamed("node", "rep"), "rep")
    lowest = lows.groupBy(F.col("root").alias("top")).agg(F.min("low").alias("component"))
    lowest = lowest.withColumnRenamed("top", "root")
    return _salted(lows, lowest, "root").select("rep", "component")


def _salted(rows: DataFrame, one_each: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of the one row of their key. Rows of a hot key are dealt to
    ``SALTS`` tasks, each of which gets that row."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("rep", F.lit(2)), F.lit(SALTS)).cast("int"))
    return dealt.join(one_each.withColumn("salt", salts), [key, "salt"]).drop("salt")


def report(documents: DataFrame, block_classes: int = BLOCK_CLASSES, percent: int = PERCENT) -> DataFrame:
    """Per document its set size, the smallest id of its component, and whether it is kept."""
    folder = fresh_folder(documents.sparkSession, "neardup")
    rows = sketches(documents, folder)
    keys = ["n_shingles", "key1", "key2"]
    linkable = rows.where("n_shingles > 0 and doc_id is not null")
    one = F.min_by(F.struct("row", "doc_id", "text_hash", "signature"), "row").alias("one")
    found = linkable.groupBy(*keys).agg(one, F.min("doc_id").alias("low"))
    found = found.select(*keys, F.col("one.row").alias("rep"), "one.doc_id", "one.text_hash", "one.signature", "low")
    classes = stored(found, folder, "classes")

    groups = stored(near_groups(documents, classes, folder, block_classes, percent), folder, "components")
    labels = classes.join(groups, "rep", "left").select(*keys, F.coalesce("component", "low").alias("component"))
    labelled = rows.select("doc_id", *keys).join(labels, keys, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return labelled.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def one_of_each(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``documents`` without near-duplicates: of each component the row of smallest id
    stays. Equal rows are one; rows with a null id stay."""
    gone = report(documents, percent=percent).where("not kept").select("doc_id").distinct()
    stay = documents.join(gone, "doc_id", "left_anti")
    text = unused("text_hash", documents.columns)
    hashed = stay.where("doc_id is not null").withColumn(text, F.xxhash64("text", F.length("text")))
    return hashed.dropDuplicates(["doc_id", text]).drop(text).unionAll(stay.where("doc_id is null"))
