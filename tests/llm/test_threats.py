"""Threat and target clauses: matched on both sides of the target, scored with learned evidence."""

import math

from maintspark.llm import toxic_grammar as tg

MACHINE = tg.grammar()
NONE = tg.Lexicon({})


def kinds(text):
    return set(tg.clause_uses(text, NONE, MACHINE)[1])


def test_threat_clauses():
    assert {frozenset(k) for k in kinds("I will kill you")} == {frozenset("Ht")}
    assert {frozenset(k) for k in kinds("you I will kill")} == {frozenset("Ht")}
    assert {frozenset(k) for k in kinds("I will not kill you")} == {frozenset("Hnt")}
    assert {frozenset(k) for k in kinds("he said I kill you")} == {frozenset("Hrt")}
    assert kinds("I will kill time, you know") == set()  # no target in its clause


def test_threats_are_scored_and_learned(spark):
    model = tg.Model(tg.Lexicon({"idiot": [3.0] * tg.USES}), tg.PRIOR, 1.0, -2.0, threat=2.5)
    neutral, threat = model.score("hello there friend"), model.score("I will kill you, and burn you, and hurt you")
    assert math.isclose(threat, 1 / (1 + math.exp(-0.5))) and math.isclose(neutral, 1 / (1 + math.exp(2)))
    assert neutral < model.score("I will not kill you") < threat

    def learned(threats_toxic):
        rows = [(i, f"we will kill you number {i}", int(threats_toxic)) for i in range(20)] + [(100 + i, f"a plain text of number {i}", 0) for i in range(40)] \
            + [(200 + i, f"something else of number {i}", 1) for i in range(10)]
        df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        return tg.learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))

    bad, harmless = learned(True), learned(False)
    assert bad.threat > 2 and harmless.threat < bad.threat
    assert bad.score("they will kill you") > max(0.5, bad.score("good day to all"))


def test_target_may_add(spark):
    rows = [(i, f"du zzidiot {i}", 1) for i in range(60)] + [(100 + i, f"zzidiot text {i}", int(i % 3 > 0)) for i in range(60)] + [(300 + i, f"words here {i}", 0) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = tg.learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert model.weights["t"] > 0 and model.score("du zzidiot") > model.score("zzidiot")
