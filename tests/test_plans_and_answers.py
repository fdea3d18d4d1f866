import itertools
import random

import pytest
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import json_text as J
from kpiloom.operators import knowledge, payloads, planning, report, responses
from kpiloom.session import stage
from tests.conftest import table


def _answers(spark, texts, extra=""):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "case_id int, text string")


def _one(spark, text, mode):
    return spark.createDataFrame([(text,)], "t string").select(J.extract_json("t", mode)).first()[0]


def test_fences(spark):
    tagged = 'Sure\n```json\n{"a": {"b": 1}}\n``` and ```json {"c": 2} ```'
    assert _one(spark, tagged, "object") == '{"a": {"b": 1}}'
    assert _one(spark, '```\n{"a": 1}\n```', "object") == '```\n{"a": 1}\n```'
    assert _one(spark, '```\n{"a": 1}\n```', "any_fence") == '{"a": 1}'
    assert _one(spark, '```json\n[1, 2]\n```', "array") == "[1, 2]"
    assert _one(spark, '\n {"a": 1} \n', "object") == '{"a": 1}'
    assert _one(spark, "```json no object```", "object") == "```json no object```"
    assert _one(spark, 'x ```json\n{"a": 1}\n``` y', "split") == '{"a": 1}'
    assert _one(spark, "x ```\n[3]\n``` y", "split") == "[3]"


def test_long_answers_are_read_whole(spark):
    body = '{"closed": true, "checks": [], "note": "' + "x" * 300_000 + '"}'
    out = responses.verdict_response(_answers(spark, ["```json\n" + body + "\n```"])).first()
    assert out["valid"] and out["closed"]


def test_verdict_truth_values(spark):
    values = ['true', 'false', '"false"', '""', 'null', '0', '2', '[]', '[0]', '{}', '{"a": 1}']
    out = responses.verdict_response(_answers(spark, ['{"closed": %s, "checks": []}' % v for v in values]))
    got = [r["closed"] for r in out.orderBy("case_id").collect()]
    assert got == [True, False, True, False, False, False, True, False, True, False, True]
    bad = responses.verdict_response(_answers(spark, ["[]", "no", '{"closed": true}', None]))
    assert [(r["valid"], r["closed"], r["error"]) for r in bad.orderBy("case_id").collect()] == [
        (False, None, "missing required fields"), (False, None, "not JSON"), (False, None, "missing required fields"),
        (False, None, "not JSON")]


def test_diagnosis_defaults_apply_to_absent_keys_only(spark):
    texts = ['{}', '{"confidence": null}', '{"confidence": "abc"}', '{"confidence": true, "primary_cause": "high_load"}', "[1]"]
    out = responses.diagnosis_response(_answers(spark, texts)).orderBy("case_id").collect()
    assert [r["valid"] for r in out] == [True, False, False, True, False]
    assert (out[0]["rca"]["primary_cause"], out[0]["rca"]["confidence"], out[0]["rca"]["evidence"]) == ("inconclusive", 0.5, [])
    assert (out[3]["rca"]["primary_cause"], out[3]["rca"]["confidence"]) == ("high_load", 1.0)


def test_signal_list_takes_first_eight(spark):
    item = '{"metric": "m%d", "value": 1, "baseline": 1, "delta_pct": 1, "dir": "up"}'
    text = "[" + ", ".join(item % i for i in range(10)) + "]"
    late = "[" + ", ".join(["{}"] * 8 + [item % 1]) + "]"
    out = responses.signal_response(_answers(spark, [text, late])).orderBy("case_id").collect()
    assert [s["metric"] for s in out[0]["signals"]] == [f"m{i}" for i in range(8)]
    assert not out[1]["valid"] and out[1]["signals"] is None


def test_answer_or_rule(spark):
    rule = spark.createDataFrame([(0, ("a",)), (1, ("b",)), (2, ("c",))], "case_id int, x struct<v:string>")
    answers = spark.createDataFrame([(0, True, ("A",)), (1, False, None)], "case_id int, valid boolean, x struct<v:string>")
    out = responses.coalesce_response(rule, answers, "x").select("case_id", "x.v", "source")
    assert table(out, "case_id", "v", "source") == [(0, "A", "answer"), (1, "b", "rule"), (2, "c", "rule")]


def test_whitelist_overwrites_and_rejects(spark):
    allowed = planning.action_whitelist(spark)
    assert allowed.count() == 11
    made = spark.createDataFrame(
        [(1, 1, "check_backhaul", True), (1, 2, "nonsense", True), (2, 1, None, False)],
        "case_id int, pos int, action_id string, reversible boolean")
    assert table(planning.validate_actions(made, allowed), "case_id", "action_id", "reversible") == [(1, "check_backhaul", False)]
    assert table(planning.rejected_actions(made, allowed), "case_id", "action_id") == [(1, "nonsense"), (2, None)]
    plans = spark.createDataFrame([(1,), (2,), (3,)], "case_id int")
    assert table(planning.invalid_plans(plans, made, allowed), "case_id") == [(2,), (3,)]


def test_plan_assembly(spark):
    texts = [
        '{"actions": [{"id": "check_backhaul", "params": {"cell": "c"}, "reversible": true}, {"id": "x"}, {"no": 1}], "postchecks": ["p"]}',
        '{"actions": [{"id": "x"}]}', '{"actions": []}', "[]", "nope", '{"prechecks": null, "actions": [{"id": "raise_prb_cap"}]}']
    out = planning.assemble_plans(_answers(spark, texts)).orderBy("case_id").collect()
    first = out[0]["plan"]
    assert [(a["id"], a["reversible"], a["params"]) for a in first["actions"]] == [("check_backhaul", False, {"cell": "c"})]
    assert first["prechecks"] == fv.DEFAULT_PRECHECKS and first["postchecks"] == ["p"]
    assert (first["sla"]["verify_minutes"], first["sla"]["success_criteria"]) == (15.0, "all_postchecks_green")
    assert [r["error"] for r in out[1:]] == ["no valid actions proposed"] * 2 + ["not a JSON object"] * 2 + [None]
    assert out[5]["plan"]["prechecks"] is None


def test_risk_order(spark):
    made = spark.createDataFrame(
        [(1, 1, "raise_prb_cap"), (1, 2, "soft_reset_rru"), (2, 1, "soft_reset_rru"), (2, 2, "raise_prb_cap")]
        + [(3, i, "raise_prb_cap") for i in range(4)], "case_id int, pos int, action_id string")
    out = planning.plan_risk_order(made, planning.action_whitelist(spark))
    assert table(out, "case_id", "n_actions", "risk_order_broken", "too_many_actions") == [
        (1, 2, False, False), (2, 2, True, False), (3, 4, False, True)]


def test_blast_radius_counts(spark):
    rows = [(1, {"cell": "a"}), (1, {"neighbor": "AUTO"}), (1, {"neighbor": "a"}), (2, {"cluster": "z"})]
    rows += [(3, {"cell": c}) for c in "abcd"]
    out = planning.blast_radius(spark.createDataFrame(rows, "case_id int, params map<string,string>"))
    assert table(out, "case_id", "n_cells", "blast_radius_ok") == [(1, 1, True), (2, 0, True), (3, 4, False)]


def test_execution_fallback_is_the_plan(spark):
    df = _answers(spark, ["nope", None, '{"status": "ok"}']).withColumn(
        "actions", F.array(F.struct(F.lit("check_backhaul").alias("id"), F.create_map(F.lit("cell"), F.lit("c")).alias("params"))))
    out = responses.execution_response(df, "actions").orderBy("case_id").collect()
    for r in out[:2]:
        done = r["execution"]["executed"]
        assert [(d["id"], d["status"], d["method"], d["params"]) for d in done] == [("check_backhaul", "applied", "simulated", {"cell": "c"})]
        assert (r["execution"]["status"], r["execution"]["mode"]) == ("ok", "simulated")
    assert out[2]["valid"] and out[2]["execution"]["executed"] == []


def test_payload_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, "A", None, 2.0, 1.0)], "case_id int, cell_name string, before_bler_dl double, after_bler_dl double, base_bler_dl double")
    text = payloads.verification_payload(df, ["bler_dl"]).first()["payload"]
    assert text == '{"cell":"A","before":{"bler_dl":null},"after":{"bler_dl":2.0},"baseline":{"bler_dl":1.0}}'


# ---- case memory ---------------------------------------------------------------------------

def _similar(cases, learnings, k=3):
    """Every pair scored, the plain way."""
    out = []
    for case, signals, cause in cases:
        scored = []
        for lid, signature, pattern in sorted(learnings):
            overlap = len(set(signals) & set(signature)) / max(len(set(signals)), 1)
            score = overlap * 0.6 + (1.0 if pattern == cause else 0.3) * 0.4
            if score > 0.3:
                scored.append((lid, score))
        scored.sort(key=lambda x: -x[1])
        out += [(case, i + 1, lid, score) for i, (lid, score) in enumerate(scored[:k])]
    return out


def test_similar_cases_by_brute_force(spark):
    rng = random.Random(12)
    words, causes = list("abcdefghijkl"), ["p", "q", "r"]

    def pick(most):
        return rng.sample(words, rng.randrange(0, most))

    # A third of both sides shares one shape.
    cases = [(i, ["a", "b"] if i % 3 == 0 else pick(11), "p" if i % 3 == 0 else rng.choice(causes + ["none"])) for i in range(150)]
    learnings = [(i, ["a", "z"] if i % 3 == 0 else pick(6), "p" if i % 3 == 0 else rng.choice(causes)) for i in range(200)]
    rng.shuffle(learnings)
    got = knowledge.similar_cases(
        spark.createDataFrame(cases, "case_id int, signals array<string>, cause string"),
        spark.createDataFrame(learnings, "learning_id int, signature array<string>, cause_pattern string"))
    want = sorted(_similar(cases, learnings))
    assert sorted(tuple(r) for r in got.collect()) == [tuple(w) for w in want]


def test_overlap_of_exactly_three_tenths_is_not_enough(spark):
    signals = list("abcdefghij")
    got = knowledge.similar_cases(
        spark.createDataFrame([(1, signals, "x")], "case_id int, signals array<string>, cause string"),
        spark.createDataFrame([(1, ["a", "b", "c"], "y"), (2, ["a", "b", "c", "d"], "y")],
                              "learning_id int, signature array<string>, cause_pattern string"))
    assert table(got, "learning_id") == [(2,)]


def _best(cases, learned, k=3):
    out = set()
    for case, signals, cause in cases:
        found = []
        for i, signature, pattern in learned:
            share = len(set(signals) & set(signature)) / max(len(set(signals)), 1)
            score = share * 0.6 + (1.0 if pattern == cause else 0.3) * 0.4
            if score > 0.3:
                found.append((-round(score, 9), i))
        out.update((case, rank, i) for rank, (_, i) in enumerate(sorted(found)[:k], 1))
    return out


@pytest.mark.parametrize("hot", [1, 5, 40, 1000])
def test_similar_cases_of_free_form_signatures(spark, monkeypatch, hot):
    """Common signals, rare signals and both, whatever counts as common."""
    monkeypatch.setattr(knowledge, "HOT_POSTINGS", hot)
    rng = random.Random(hot)
    signals = [f"s{i}" for i in range(60)]
    weights = [1 / (1 + i) for i in range(60)]

    def some(most):
        return list(dict.fromkeys(rng.choices(signals, weights, k=rng.randrange(most))))

    cases = [(i, some(9), rng.choice(["a", "b", "c", None])) for i in range(120)] + [(500, ["s0", "new"], "a"), (501, [], "b")]
    learned = [(i, some(7), rng.choice(["a", "b", "d"])) for i in range(300)] + [(900, ["s0"], "a"), (901, [], "b")]
    got = knowledge.similar_cases(
        spark.createDataFrame(cases, "case_id int, signals array<string>, cause string"),
        spark.createDataFrame(learned, "learning_id int, signature array<string>, cause_pattern string"))
    assert {(r["case_id"], r["rank"], r["learning_id"]) for r in got.collect()} == _best(cases, learned)


def test_one_signal_shared_by_all_makes_few_pairs(spark):
    """100,000 distinct signatures with one shared signal: pairs stay far from all of them."""
    n = 100_000
    learned = spark.range(n).select(
        F.col("id").alias("learning_id"),
        F.array(F.lit("shared"), F.concat(F.lit("own"), F.col("id").cast("string")), F.concat(F.lit("few"), (F.col("id") % 5000).cast("string"))).alias("signature"),
        F.concat(F.lit("cause"), (F.col("id") % 3).cast("string")).alias("cause_pattern"))
    asked = spark.range(2000).select(
        F.col("id").alias("case_id"),
        F.array(F.lit("shared"), F.concat(F.lit("few"), (F.col("id") % 5000).cast("string")), F.concat(F.lit("mine"), F.col("id").cast("string"))).alias("signals"),
        F.concat(F.lit("cause"), (F.col("id") % 4).cast("string")).alias("cause"))
    shape = lambda c: F.sort_array(c)
    cases_ = stage(asked.select(shape("signals").alias("signals"), "cause").distinct())
    oldest = stage(learned.select("learning_id", shape("signature").alias("signature"), "cause_pattern"))
    pairs = knowledge.similar_candidates(cases_, oldest, 3).distinct().count()
    assert 2000 * 20 <= pairs <= 2000 * 40  # of 2 * 10 ** 8
    got = {r["case_id"]: [] for r in asked.collect()}
    for r in knowledge.similar_cases(asked, learned).orderBy("rank").collect():
        got[r["case_id"]].append((r["learning_id"], round(r["score"], 9)))
    for i in (0, 1, 2, 3, 777, 1999):
        fit = [(-(0.6 * 2 / 3 + (0.4 if j % 3 == i % 4 else 0.12)), j) for j in range(i % 5000, n, 5000)]
        assert got[i] == [(j, round(-s, 9)) for s, j in sorted(fit)[:3]]


def test_recommendations_need_citation_and_confidence(spark):
    similar = spark.createDataFrame([(1, 1, i) for i in range(4)], "case_id int, rank int, learning_id int")
    learned = spark.createDataFrame([(0, "yes", 0.905), (1, "", 0.9), (2, None, 0.9), (3, "half", 0.5)],
                                    "learning_id int, citation string, confidence double")
    assert table(knowledge.recommendations(similar, learned), "recommendation") == [("yes (confidence: 90.5%)",)]


# ---- reports -------------------------------------------------------------------------------

def test_closure_of_nothing_is_null(spark):
    out = report.closure_summary(spark.createDataFrame([], "closed boolean")).first()
    assert (out["total_cases"], out["closed_cases"], out["closed_pct"]) == (0, 0, None)


def test_cause_ties_by_first_appearance(spark):
    rows = [(5, "b"), (1, "c"), (2, "a"), (3, "a"), (4, "b")]
    out = report.cause_breakdown(spark.createDataFrame(rows, "case_id int, primary_cause string")).collect()
    assert [(r["primary_cause"], r["n_cases"]) for r in out] == [("a", 2), ("b", 2), ("c", 1)]


def test_history_text(spark):
    log = spark.createDataFrame([("x", i, f"p{i}", "r" * 150) for i in range(7)], "agent string, at int, prompt string, response string")
    agents = spark.createDataFrame([("x",), ("y",)], "agent string")
    out = {r["agent"]: r["summary"] for r in report.history_summary(log, agents, ["at"]).collect()}
    want = "Conversation History (7 exchanges):\n"
    for i, n in enumerate(range(2, 7), 1):
        want += f"\n{i}. Prompt: p{n}...\n   Response: {'r' * 100}...\n"
    assert out == {"x": want, "y": "No conversation history"}


def test_every_known_cause_is_reachable():
    assert len(set(itertools.chain(fv.CAUSE_CONFIDENCE))) == 6
