import random

import brutes
import pytest
from corpus_samples import ODD_TEXTS

from kpiloom.llm import quality_rules


def texts():
    rng = random.Random(1)
    out = list(ODD_TEXTS)
    for _ in range(60):
        ws = [rng.choice(["the", "of", "Word", "LOUD!!", "a#b", "x|", "long" * 9, "é", "same same"]) + rng.choice("abc")
              for _ in range(rng.randint(1, 60))]
        out.append("".join(w + rng.choice(" \t\n\x0b\r  ") for w in ws))
        out.append(" ".join(f"{rng.choice('abcdef')}{rng.randrange(50)}" for _ in range(40)))
        out.append(" ".join(["one two three four five", *ws[:5], "one two three four five six"] * rng.randint(1, 3)))
        out.append("\n".join(rng.choice(["a line of six plain words", "some other line of words", " ", ""]) for _ in range(9)))
        out.append("PLAIN TEXT IN CAPITALS " + " ".join(f"W{rng.randrange(99)}QX" for _ in range(12)))
    return out


def test_against_brute_force(spark, docs_of):
    all_texts = texts()
    rows = quality_rules.judge(docs_of(all_texts)).drop("reason").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in rows}
    for i, t in enumerate(all_texts):
        assert got[i] == brutes.quality(t), t[:80]
    kept = quality_rules.keep_good(docs_of(all_texts))
    assert kept.columns == docs_of([]).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, r in sorted(got.items()) if r[-1]]
    assert 0 < kept.count() < len(all_texts)


@pytest.mark.parametrize("seed", [1, 2])
def test_order_changes_no_verdict(spark, docs_of, monkeypatch, seed):
    all_texts = texts()[:80]
    order = list(quality_rules.RULES)
    random.Random(seed).shuffle(order)
    monkeypatch.setattr(quality_rules, "rule_order", lambda *a, **k: order)
    rows = quality_rules.judge(docs_of(all_texts)).collect()
    assert {r["doc_id"]: r["kept"] for r in rows} == {i: brutes.quality(t)[-1] for i, t in enumerate(all_texts)}
    assert all((r["reason"] is None) == r["kept"] for r in rows)


def test_order_follows_rejections_per_work(spark, docs_of):
    shouting = docs_of([" ".join(f"word{i}!! other{i}!!" for i in range(20))] * 40)
    assert quality_rules.rule_order(shouting)[0].name == "shouting"
    short = docs_of(["a few words only"] * 40)
    assert quality_rules.rule_order(short)[0].name == "few_words"


def test_a_slow_rule_moves_back_however_cheap_it_looks(spark, docs_of, monkeypatch):
    """Two rules reject alike; the one whose feature takes long when timed goes last, unless it is paid for."""
    from pyspark.sql import functions as F

    def digest(c):
        return F.length(F.aggregate(F.sequence(F.lit(1), F.lit(3000)), c["text"], lambda a, _: F.sha2(a, 512)))

    features = {"slow": quality_rules.Feature(("text",), digest), "fast": quality_rules.Feature(("text",), lambda c: F.length(c["text"]))}
    monkeypatch.setattr(quality_rules, "FEATURES", features)
    rules = tuple(quality_rules.Rule(n, (n,), lambda c, n=n: c[n] > 0) for n in ("slow", "fast"))
    docs = docs_of(["some text"] * 300)
    assert [r.name for r in quality_rules.rule_order(docs, rules=rules)] == ["fast", "slow"]
    assert [r.name for r in quality_rules.rule_order(docs, rules=rules, paid=("slow",))] == ["slow", "fast"]


def test_the_sample_comes_from_all_partitions(spark, docs_of, monkeypatch):
    """Rows that only the last partition holds count as well."""
    monkeypatch.setattr(quality_rules, "SAMPLE_ROWS", 400)
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(i, good, None) for i in range(3000)] + [(i, "### " * 30, None) for i in range(3000, 4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartitionByRange(8, "doc_id")
    assert quality_rules.rule_order(docs)[0].name in ("symbols", "repeated_windows", "stutter")


def test_scripts_without_blanks_have_no_long_words(spark, docs_of):
    line = "我们今天讨论数据处理的方法首先要读取所有文件然后删除重复的段落最后把结果写入新的表格"
    rows = [(1, "\n".join(f"{line}{chr(0x4e00 + 7 * i)}" for i in range(12))), (2, "\n".join(f"{'abcdefg' * 6}{i}" for i in range(12)))]
    got = {r["doc_id"]: (r["kept"], r["reason"]) for r in quality_rules.judge(docs_of(rows)).collect()}
    assert got == {1: (True, None), 2: (False, "long_words")}


def test_long_runs(spark, docs_of):
    runs = [" " * 10**6, "\n" * 10**6, "x" * 10**6, "!" * 10**6, "我" * 10**6, "ab " * 200_000]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs_of(runs)).collect()}
    assert got == {i: False for i in range(len(runs))}


def test_empty_table(spark, docs_of):
    assert quality_rules.judge(docs_of([])).count() == 0
    assert quality_rules.keep_good(docs_of([])).count() == 0


def test_repeated_rows_and_null_ids(spark, docs_of):
    good = " ".join(f"word{i}" for i in range(30))
    kept = quality_rules.keep_good(docs_of([(1, good), (1, good), (None, good), (None, None)])).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "1", "None"]
