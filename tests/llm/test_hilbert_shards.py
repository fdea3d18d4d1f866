import itertools
import zlib

import pytest
from corpus_samples import ODD_TEXTS
from pyspark.sql import functions as F

from kpiloom.llm import hilbert_shards
from kpiloom.session import stage_path


@pytest.mark.parametrize("n, bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_every_cell_in_unit_steps(spark, n, bits):
    cells = list(itertools.product(range(1 << bits), repeat=n))
    names = [f"c{i}" for i in range(n)]
    df = spark.createDataFrame(cells, ", ".join(f"{c} int" for c in names))
    rows = df.select(*names, hilbert_shards.curve_place([F.col(c) for c in names], bits).alias("place")).collect()
    at = {r["place"]: tuple(r)[:n] for r in rows}
    assert sorted(at) == list(range(len(cells)))
    for k in range(len(cells) - 1):
        assert sum(abs(a - b) for a, b in zip(at[k], at[k + 1])) == 1


def check(rows, texts, shards):
    assert sorted((r["text_crc32"], r["size"]) for r in rows) == sorted(
        (zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for t in texts)
    by = {}
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        by.setdefault(r["shard"], []).append(r)
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["place"] for r in order] == sorted(r["place"] for r in rows)


@pytest.mark.parametrize("n", [1, 13, 40, 97, 400])
def test_rows_law_and_slots(spark, docs_of, n):
    texts = [(ODD_TEXTS + [f"text {i} " * (i % 50) for i in range(n)])[i] for i in range(n)]
    check(hilbert_shards.shard_documents(docs_of(texts)).collect(), texts, 40)


def test_ties_repeats_nulls_and_empty(spark, docs_of):
    texts = [(1, "same")] * 90 + [(None, None)] * 30
    check(hilbert_shards.shard_documents(docs_of(texts), shards=7).collect(), [t for _, t in texts], 7)
    assert hilbert_shards.shard_documents(docs_of([])).count() == 0


def test_kept_columns_dimensions_and_files(spark, docs_of):
    docs = docs_of([f"text {i} " * i for i in range(60)])
    placed = hilbert_shards.shard_documents(
        docs, shards=4, dimensions={"length": F.length("text"), "id": F.col("doc_id")}, keep=("text", "key"))
    path = stage_path(spark, "shards")
    hilbert_shards.write_shards(placed, path)
    back = spark.read.parquet(path)
    assert sorted(r["text"] for r in back.collect()) == sorted(r["text"] for r in docs.collect())
    spans = back.groupBy("shard").agg(F.max("doc_id") - F.min("doc_id")).collect()
    assert max(s[1] for s in spans) < 40  # shards are near in the id as well
