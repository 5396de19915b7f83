"""Every stage against plain code, each on what the one before kept."""

from collections import Counter

import corpus_pipeline
import test_decontaminate
import test_mixture
import test_near_dups
import test_secret_scan
from llm_fixtures import documents, edges, prose, table, tuples  # noqa: F401

from tillwork.llm.toxicity import toxicity

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_stages(spark, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixture"]
    docs, labels, benchmark = (
        spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark")
    )
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = rows(docs)
        out = stage(spark, docs, SF)
        assert out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/{n}")
        after = spark.read.parquet(f"{tmp_path}/{n}")
        if name == "toxicity":
            bad = {r["doc_id"] for r in toxicity(docs, labels).collect() if r["predicted"]}
            want = [r for r in before if r[0] not in bad]
        elif name == "near_duplicates":
            groups = test_near_dups.expected([r[:2] for r in before], 5, 80)
            kept = {i for i, _, _, stays in groups if stays}
            want = [r for r in before if r[0] in kept]
        elif name == "decontamination":
            hits = {i for i, _, _ in test_decontaminate.expected(short(before, items), items)}
            want = [r for r in before if r[0] not in hits]
        elif name == "secrets":
            want = [redacted(r) for r in before]
        else:
            taken = test_mixture.expected([(r[0], r[1], r[3]) for r in before])
            times = {i: took // size for i, size, _, _, took in taken if size}
            want = [r for r in before for _ in range(times.get(r[0], 0))]
        assert Counter(rows(after)) == Counter(want), name
        if name in ("toxicity", "near_duplicates", "decontamination"):
            assert 0 < len(before) - len(want) < len(before) / 2, name
        docs = after


def short(docs, items):
    """Texts that share eight characters in a row with an item; others cannot match."""
    return [
        (i, t)
        for i, t, *_ in docs
        if any(p in test_decontaminate.normal(t) for _, x in items for p in eighths(x))
    ]


def eighths(text):
    text = test_decontaminate.normal(text)
    edits = test_decontaminate.budget(len(text), 8, 64)
    return [p for _, p in test_decontaminate.pieces(text, edits)]


def redacted(row):
    text, out, place = row[1], "", 0
    spans = test_secret_scan.spans_of(text)
    for _, start, end in spans:
        if start >= place:
            out += text[place:start] + "[secret]"
        place = max(place, end)
    out += text[place:]
    return (row[0], out, *row[2:4], len(out) if spans else row[4])


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == COLUMNS and out.count() > 100


def test_edges(spark, documents, table, prose, tmp_path):
    docs = documents([(*r, "a") for r in edges(prose)])
    labels = [(4, 1, 0)]
    folder = str(tmp_path)
    table(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    table([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    work = docs
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, work, folder)
        assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{n}")
        work = spark.read.parquet(f"{folder}/{n}")
    assert {r["doc_id"] for r in work.collect()} <= {i for i, _ in edges(prose)}


def test_empty_table(spark, documents, table, tmp_path):
    table([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    table([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0
