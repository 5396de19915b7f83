"""Near-duplicate documents by MinHash, banding and connected components."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.graph import components
from tillwork.llm.words import Rolling, WordHashes, mixed, signed, words
from tillwork.llm.workspace import Workspace, lists, map_batches
from tillwork.operators.hot import spread

# The chance that banding misses a pair just at the threshold.
MISS = 1e-6
# Buckets up to this size compare all their classes that are still apart.
SMALL_BUCKET = 32


def bands_for(percent: int) -> tuple[int, int]:
    """Bands and minima in each, for a Jaccard similarity of ``percent`` or more.

    As many bands as let a pair at the threshold share less than two of them with a chance
    of ``MISS`` at most.
    """
    rows = 5 if percent >= 85 else 4 if percent >= 75 else 3
    share, bands = (percent / 100) ** rows, 2
    while (1 - share) ** bands + bands * share * (1 - share) ** (bands - 1) > MISS:
        bands += 1
    return bands, rows


def _shingles(shingle: int):
    """A function from a text to the sorted 64-bit hashes of its word shingles.

    A text with fewer words is one shingle of all of them; without words it has none.
    """
    hashes, full, short = WordHashes(), Rolling(shingle), Rolling(1000 + shingle)

    def of(text):
        tokens = words(text, lower=True)
        if not tokens:
            return np.empty(0, np.uint64)
        of_words = hashes.of(tokens)
        if len(tokens) < shingle:
            return short.windows(of_words, len(tokens))
        return np.unique(full.windows(of_words, shingle))

    return of


def _signed(docs: DataFrame, shingle: int, minima: int) -> DataFrame:
    """Size, 128-bit identity and minima of each row's shingle set."""

    def make():
        shingles = _shingles(shingle)
        draws = mixed(np.arange(1, 2 * minima + 1, dtype=np.uint64))
        factors, shifts = (draws[:minima] | np.uint64(1))[:, None], draws[minima:][:, None]

        def signature(hashes):
            least = np.full(minima, np.iinfo(np.uint64).max)
            for start in range(0, len(hashes), 512):
                block = factors * hashes[start : start + 512] + shifts
                np.minimum(least, block.min(axis=1), out=least)
            return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)

        def convert(rows):
            sizes, sets, minimum = [], [], []
            for text in rows["text"]:
                hashes = shingles(text)
                sizes.append(len(hashes))
                sets.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                minimum.append(signature(hashes) if len(hashes) else np.empty(0, np.int32))
            return {
                "doc_id": rows["doc_id"],
                "x": rows["x"],
                "n_shingles": sizes,
                "class": sets,
                "minima": lists(minimum, pa.int32()),
            }

        return convert

    schema = "doc_id long, x long, n_shingles long, class binary, minima array<int>"
    return map_batches(docs, schema, make)


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """The shingle sets of the texts whose set has the identity asked for."""

    def make():
        shingles = _shingles(shingle)

        def convert(rows):
            kept, sets = [], []
            for text, key in zip(rows["text"], rows["class"], strict=True):
                hashes = shingles(text)
                if xxhash.xxh3_128_digest(hashes.tobytes()) == key:
                    kept.append(key)
                    sets.append(signed(hashes))
            return {"class": kept, "hashes": lists(sets, pa.int64())}

        return convert

    return map_batches(texts, "class binary, hashes array<long>", make)


def _band_keys(bands: int, rows: int) -> Column:
    """The hash of each band of ``minima``."""
    return F.array(
        *[
            F.xxhash64(F.lit(b), *[F.col("minima")[b * rows + r] for r in range(rows)])
            for b in range(bands)
        ]
    )


def _each(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Adds the columns of both classes of each pair, as ``a_<column>`` and ``b_<column>``."""
    for side in ("a", "b"):
        names = [F.col(c).alias(f"{side}_{c}") for c in columns]
        pairs = pairs.join(table.select(F.col("class").alias(side), *names), side)
    return pairs


def _linked(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough, found by signature and settled on full sets."""
    pairs = _each(pairs, classes, ["n_shingles", "minima", "doc_id"])
    fits = 100 * F.least("a_n_shingles", "b_n_shingles") >= percent * F.greatest(
        "a_n_shingles", "b_n_shingles"
    )
    agree = F.size(F.filter(F.zip_with("a_minima", "b_minima", lambda x, y: x == y), lambda e: e))
    n = F.size("a_minima")
    # Six standard deviations below the threshold.
    s = percent / 100
    near = agree >= s * n - 6 * F.sqrt(s * (1 - s) * n)
    pairs = pairs.filter(fits & near).select(
        "a", "b", F.col("a_doc_id").alias("u"), F.col("b_doc_id").alias("v")
    )
    pairs = _each(pairs, sets, ["hashes"])
    both = F.size(F.array_intersect("a_hashes", "b_hashes"))
    union = F.size("a_hashes") + F.size("b_hashes") - both
    return pairs.filter(100 * both >= percent * union).select("u", "v")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Groups documents whose word shingles overlap, directly or through others.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A-Z are lowered.
    Two documents are linked if ``100 * |intersection| >= percent * |union|`` over their
    sets of ``shingle``-word shingles. Returns one row for each input row: ``doc_id,
    n_shingles, component_id`` (the smallest id reachable) and ``kept`` (whether that is
    the row's own).

    Rows with equal sets are one class and need no comparison. Classes that share a band
    of minima are candidates; the chance to miss a pair at the threshold is below
    ``MISS``, and smaller above it. In a bucket of any size each class is first compared
    with the most central one alone, which ties a group of near copies together with one
    comparison for each. Only buckets that then still hold several components go on: small
    ones with all pairs that are apart, large ones by an exact prefix filter.

    A missing or empty text, or one without words, has no shingles and no links. A row
    without an id has no component and is kept. Rows that repeat an id are one node.
    """
    bands, rows = bands_for(percent)
    work = Workspace(docs.sparkSession)
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("x")
    )
    signed_rows = work.put(_signed(docs, shingle, bands * rows))
    classes = work.put(
        signed_rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.min(F.struct("doc_id", "x")).alias("of"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("minima").alias("minima"),
        )
    )
    buckets = classes.select("class", "doc_id", F.explode(_band_keys(bands, rows)).alias("bucket"))
    shared = (
        buckets.groupBy("bucket", spread("bucket"))
        .agg(F.min("class").alias("least"), F.max("class").alias("most"))
        .filter("least < most")
        .select("bucket")
    )
    members = work.put(buckets.join(shared, "bucket"))
    # One text of each class, found by id and text: an id may have many.
    wanted = (
        members.select("class")
        .distinct()
        .join(classes.select("class", "of"), "class")
        .select("class", "of.doc_id", "of.x")
    )
    sets = work.put(
        _sets(docs.join(wanted, ["doc_id", "x"]).select("class", "text"), shingle).dropDuplicates(
            ["class"]
        )
    )

    # Rows with one set are linked even if the set is all they share.
    copies = (
        signed_rows.select("doc_id", "class")
        .distinct()
        .join(classes.select("class", F.col("doc_id").alias("v"), spread("class")), "class")
        .filter("doc_id <> v")
        .select(F.col("doc_id").alias("u"), "v")
    )
    centres = work.put(_centres(members))
    central = members.join(centres, "bucket").filter("class <> centre")
    central = work.put(central.select(*_ordered("class", "centre")).distinct())
    groups = components(copies.unionByName(_linked(central, classes, sets, percent)), work)
    apart = work.put(_in_two_buckets(_still_open(members, groups)))
    # Each step is written: the next read it several times, and one plan of all of them, which
    # the driver holds anew after every stage, takes hundreds of megabytes there.
    references = work.put(_references(apart, members, centres))
    around = work.put(_around(apart, references, sets))
    first = work.put(_prefixes(around, percent))
    work.drop(around)
    large = work.put(_large_bucket_pairs(first, percent))
    work.drop(first)
    pairs = _small_bucket_pairs(apart).unionByName(large)
    pairs = work.put(pairs.distinct().join(central, ["a", "b"], "left_anti"))
    groups = _joined(groups, _linked(pairs, classes, sets, percent), work)
    component = F.coalesce("component", "doc_id")
    return signed_rows.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _joined(groups: DataFrame, links: DataFrame, work: Workspace) -> DataFrame:
    """The components that ``groups`` and further links make: only the links are followed again,
    each between the components that its ends are in."""
    for end in ("u", "v"):
        of = groups.select(F.col("node").alias(end), "component")
        links = links.join(of, end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    above = components(links, work)
    of = above.select(F.col("node").alias("component"), F.col("component").alias("above"))
    moved = groups.join(of, "component", "left").select(
        "node", F.coalesce("above", "component").alias("component")
    )
    return work.put(moved.unionByName(above))


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _centres(members: DataFrame) -> DataFrame:
    """The most central class of each bucket.

    The text that near copies were made from shares more bands with them than they do
    with each other, so its buckets are larger in sum.
    """
    sizes = members.groupBy("bucket", spread("bucket")).agg(F.count(F.lit(1)).alias("size"))
    weights = (
        members.join(sizes.select("bucket", "size"), "bucket")
        .groupBy("class", spread("class"))
        .agg(F.sum("size").alias("weight"))
    )
    return (
        members.join(weights.select("class", "weight"), "class")
        .groupBy("bucket", spread("bucket"))
        .agg(F.max(F.struct("weight", "class")).alias("most"))
        .select("bucket", F.col("most.class").alias("centre"), "most.weight")
    )


def _still_open(members: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components, with the bucket's size."""
    placed = (
        members.withColumnRenamed("doc_id", "node")
        .join(groups, "node", "left")
        .select("class", "bucket", F.coalesce("component", "node").alias("group"))
    )
    several = (
        placed.groupBy("bucket", spread("bucket"))
        .agg(
            F.min("group").alias("least"),
            F.max("group").alias("most"),
            F.count(F.lit(1)).alias("size"),
        )
        .filter("least < most")
        .select("bucket", "size")
    )
    return placed.join(several, "bucket")


def _in_two_buckets(apart: DataFrame) -> DataFrame:
    """The rows of classes that lie in two open buckets or more, as both of a similar pair do."""
    several = apart.groupBy("class", spread("class")).agg(F.count(F.lit(1)).alias("n"))
    return apart.join(several.filter("n > 1").select("class"), "class")


def _small_bucket_pairs(apart: DataFrame) -> DataFrame:
    """All pairs of classes of different groups in buckets of up to ``SMALL_BUCKET``."""
    small = apart.filter(F.col("size") <= SMALL_BUCKET)
    others = small.select("bucket", F.col("class").alias("other"), F.col("group").alias("its"))
    pairs = small.join(others, "bucket").filter("class < other AND group <> its")
    return pairs.select(*_ordered("class", "other"))


def _references(apart: DataFrame, members: DataFrame, centres: DataFrame) -> DataFrame:
    """For each larger open bucket the most central class that its own centre meets anywhere.

    A group of near copies fills many buckets, not all of which hold the text that they were
    made from; so nearly all of them get the same reference, named ``centre``.
    """
    large = apart.filter(F.col("size") > SMALL_BUCKET).select("bucket").distinct()
    own = large.join(centres, "bucket").select("bucket", F.col("centre").alias("class"))
    met = members.join(own.select("class").distinct(), "class").join(centres, "bucket")
    best = met.groupBy("class", spread("class")).agg(
        F.max(F.struct("weight", "centre")).alias("best")
    )
    return own.join(best.select("class", "best"), "class").select(
        "bucket", F.col("best.centre").alias("centre")
    )


def _around(apart: DataFrame, references: DataFrame, sets: DataFrame) -> DataFrame:
    """The sets of the classes of larger buckets, cut by what their reference holds too."""
    around = (
        apart.filter(F.col("size") > SMALL_BUCKET)
        .join(references, "bucket")
        .select("class", "group", "centre")
        .distinct()
        .join(sets, "class")
        .join(sets.select(F.col("class").alias("centre"), F.col("hashes").alias("middle")), "centre")
    )
    return around.select(
        "centre",
        "class",
        "group",
        F.size("hashes").alias("n"),
        F.array_except("hashes", "middle").alias("own"),
        F.array_sort(F.array_intersect("hashes", "middle")).alias("common"),
    )


def _at_least(n: Column, percent: int) -> Column:
    """The least overlap of a set of ``n`` with one that is similar enough."""
    return F.ceil(n * percent / 100)


def _prefixes(around: DataFrame, percent: int) -> DataFrame:
    """The first elements of each set, as many as a similar set may have its first common one in.

    Among the classes with one reference, every set is put in the same order: first what the
    reference lacks, by how many of them hold it, rarest first, then the rest. ``left`` counts
    the elements from here on.
    """
    owned = around.select("centre", "class", F.explode("own").alias("token"))
    keys = ["centre", "token"]
    held = owned.groupBy(*keys, spread(*keys)).agg(F.count(F.lit(1)).alias("held"))
    ranked = (
        owned.join(held.select(*keys, "held"), keys)
        .groupBy("centre", "class")
        .agg(F.sort_array(F.collect_list(F.struct("held", "token")))["token"].alias("ranked"))
    )
    n = F.col("n")
    order = F.concat(F.coalesce("ranked", F.array().cast("array<long>")), F.col("common"))
    return (
        around.join(ranked, ["centre", "class"], "left")
        .select("centre", "class", "group", "n", order.alias("order"))
        .select(
            "centre",
            "class",
            "group",
            "n",
            F.posexplode(
                F.slice("order", F.lit(1), (n - _at_least(n, percent) + 1).cast("int"))
            ),
        )
        .select("centre", "class", "group", "n", F.col("col").alias("token"), (n - F.col("pos")).alias("left"))
    )


def _large_bucket_pairs(first: DataFrame, percent: int) -> DataFrame:
    """Candidates among the classes of larger buckets, none of the similar ones left out.

    ``first`` holds the first elements of their sets. Two sets that are similar enough share an
    element among those, and what follows their first common one must still be long
    enough. A near copy with many words of its own begins with those, which it shares with
    few, and what it has in common with the whole group comes too late to count.
    """
    # The overlap of two similar sets, over the sum of their sizes, is at least p / (100 + p).
    p, n, keys = percent, F.col("n"), ["centre", "token"]
    # In the smaller set of a pair fewer places count.
    shorter = first.filter((100 + p) * F.col("left") >= 2 * p * n).select(
        "centre",
        "token",
        F.col("class").alias("other"),
        F.col("group").alias("its"),
        F.col("n").alias("m"),
        F.col("left").alias("its_left"),
    )
    least = shorter.groupBy(*keys, spread(*keys)).agg(F.min("m").alias("least"))
    longer = first.join(least.select(*keys, "least"), keys).filter(
        (100 + p) * F.col("left") >= p * (n + F.greatest("least", _at_least(n, p)))
    )
    similar_sizes = (F.col("m") <= n) & (100 * F.col("m") >= p * n)
    enough = (100 + p) * F.least("left", "its_left") >= p * (n + F.col("m"))
    pairs = longer.join(shorter, keys).filter(
        (F.col("class") != F.col("other")) & (F.col("group") != F.col("its")) & similar_sizes & enough
    )
    return pairs.select(*_ordered("class", "other")).distinct()


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of ``near_duplicates``, all columns.

    The document with the smallest id stays; of rows that repeat an id, the one with the
    least text. Rows without an id all stay.
    """
    groups = near_duplicates(docs, shingle, percent)
    work = Workspace(docs.sparkSession)
    gone = work.put(groups.filter(~F.col("kept")).select("doc_id").distinct())
    again = groups.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    # Under a name of its own each row stays apart from what it is compared with.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct("*").alias("row"))
    stay = rows.join(gone, "doc_id", "left_anti")
    if again.isEmpty():
        return stay.select("row.*")
    first = (
        stay.join(again, "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min_by("row", F.coalesce("row.text", F.lit(""))).alias("row"))
    )
    once = stay.join(again, "doc_id", "left_anti")
    return once.select("row.*").unionByName(first.select("row.*"))
