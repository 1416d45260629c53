"""Every stage of the pipeline against plain Python over the stage's own input."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from maintspark.llm import toxic_grammar
from maintspark.llm.store import write_table

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """[(name, input rows, output rows)] of a run, with a null, an empty and some repeated rows added."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = spark.createDataFrame([(900001, None, "en", "srcX", None), (900002, "", "en", None, 0), (900003, "an odd row", None, "src1", 10)], docs.schema)
    docs = write_table(docs.unionByName(more).unionByName(docs.where("doc_id < 3")), "fixture")
    out = []
    for name, stage in cp.STAGES:
        made = write_table(stage(spark, docs, SF), name)
        assert made.columns == docs.columns
        out.append((name, docs, made))
        docs = made
    return {name: (a, b) for name, a, b in out}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    train = before.where(~toxic_grammar.held_out(F.col("doc_id")))
    model = toxic_grammar.learn(train, spark.read.parquet(f"{SF}/labels.parquet"))
    assert rows(after) == sorted((tuple(r) for r in before.collect() if model.score(r.text) < 0.3), key=str)


def test_lines(stages):
    before, after = stages["line_dedup"]
    docs = [tuple(r) for r in before.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    gone = brute.dropped_lines([(d[0], d[5], d[1]) for d in docs])
    want = []
    for d in docs:
        drop = gone.get((d[0], d[5]), set())
        lines = [] if d[1] is None else d[1].split("\n")
        if drop and not any(brute.space_words(x) for i, x in enumerate(lines) if i not in drop):
            continue  # lost lines, and none with a word is left
        text = d[1] if d[1] is None else "\n".join(x for i, x in enumerate(lines) if i not in drop)
        want.append((d[0], text, d[2], d[3], None if text is None else len(text)))
    assert rows(after) == sorted(want, key=str)


def test_near_copies(stages):
    before, after = stages["near_dedup"]
    docs = sorted(before.collect(), key=lambda r: r.doc_id)
    comp = brute.near_components([r.text for r in docs])
    # one row of a group, also of repeated rows; rows without words are in no group
    want = [tuple(r) for i, (r, c) in enumerate(zip(docs, comp)) if c == i or not brute.space_words(r.text)]
    assert len(want) < len(docs) and rows(after) == sorted(want, key=str)


def test_contamination(spark, stages):
    before, after = stages["decontamination"]
    win = brute.windows([(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])

    def clean(t):
        n, hit, _ = brute.contamination(t, win)
        return not (hit and 20 * len(hit) >= n) if isinstance(hit, set) else not (hit and 20 * hit >= n)

    assert rows(after) == sorted((tuple(r) for r in before.collect() if clean(r.text)), key=str)


def test_mix(stages):
    before, after = stages["mixing"]
    size = {tuple(r): len(brute.space_words(r.text)) for r in before.collect()}
    n_rows, sizes, most, taken = Counter(tuple(r) for r in before.collect()), defaultdict(int), defaultdict(int), defaultdict(int)
    for r, n in n_rows.items():
        sizes[r[3]] += n * size[r]
        most[r[3]] = max(most[r[3]], size[r])
    copies = Counter(tuple(r) for r in after.collect())
    assert set(copies) <= set(n_rows) and all(copies[r] <= 2 * n_rows[r] for r in copies)
    for r, n in copies.items():
        taken[r[3]] += n * size[r]
    want = brute.targets(sizes)
    assert all(abs(taken[s] - want[s]) <= most[s] / 2 + 1e-6 for s in sizes)


def test_run_is_the_stages(spark, stages):
    once = rows(cp.run(spark, SF))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = write_table(stage(spark, docs, SF), "again")
    assert once and once == rows(docs)
