import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from maintspark.llm import katz, pareto_mix, tool_chat, toxic_grammar, url_rules
from maintspark.llm.components import components

from . import brute

# --- components --------------------------------------------------------------------------


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)] \
        + [(2000, 2001 + i) for i in range(50)]
    comp = {x: x for e in links for x in e}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        comp[max(a, b)] = min(a, b)
    linked = {x for a, b in links if a != b for x in (a, b)}
    df = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.comp for r in components(df).collect()}
    assert got == {x: find(x) for x in linked}
    assert components(df.limit(0)).count() == 0


# --- 4 -----------------------------------------------------------------------------------

def mix_rows():
    rng = random.Random(4)
    docs = [(i, " ".join(["w"] * rng.choice((0, 1, 3, 10, 30, 200))), rng.choice(["a", "b", "B", "é", "", None])) for i in range(600)]
    return docs + [(600, None, "a"), (601, "tail w w", "b")] + [(700, "same row " * 5, "é")] * 9 + [(None, "no id", "z"), (None, "no id", "z")]


def test_mix_meets_targets(spark):
    rows = mix_rows()
    df = spark.createDataFrame([(*r, 1.0, "t") for r in rows], "doc_id long, text string, source string, size double, target string")
    size = [len(brute.space_words(t)) for _, t, _ in rows]
    sizes = defaultdict(int)
    for n, (_, _, s) in zip(size, rows):
        sizes[s] += n
    want = brute.targets(sizes)
    got = pareto_mix.mix_report(df).collect()
    assert len(got) == len(rows)
    by_id = {i: s for i, _, s in rows}
    taken, most = defaultdict(int), defaultdict(int)
    for r in got:
        s = by_id[r.doc_id]
        assert r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-12)
        assert r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
        most[s] = max(most[s], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= most[s] / 2 + 1e-6
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, pareto_mix.mix_report(df.repartition(5)).collect()), key=str)
    mixed = pareto_mix.mix(df)
    assert mixed.columns == df.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    words = Counter()
    for r in got:
        words[r.doc_id] += r.taken
    per = {i: len(brute.space_words(t)) for i, t, _ in rows}
    assert {i: n * per[i] for i, n in copies.items()} == {i: n for i, n in words.items() if n}


def test_mix_takes_some_of_equal_rows(spark):
    rows = [(1, "a b c d", "s")] * 7 + [(2, "x " * 100, "t"), (3, "y " * 3, "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = Counter(r.doc_id for r in pareto_mix.mix(df).collect())
    assert mixed[1] * 4 == sum(r.taken for r in pareto_mix.mix_report(df).where("doc_id = 1").collect())
    assert abs(mixed[1] * 4 - brute.targets({"s": 28, "t": 100, "u": 3})["s"]) <= 2
    one = pareto_mix.mix_report(df, share=1.1, weights=(2, 1, 1)).where("doc_id = 1").collect()
    assert len({r.taken for r in one}) <= 2


def test_mix_of_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert pareto_mix.mix_report(df).count() == 0 and pareto_mix.mix(df).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in pareto_mix.mix_report(blank).collect()] == [(0.0, 0)] * 2


def test_inclusion_follows_odds(spark):
    """Over many seeds each document is taken about as often as it should be."""
    rows = [(i, "w " * (1 + 7 * (i % 3)), s) for i in range(40) for s in ("a",)] + [(99, "w " * 4000, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    decided = [pareto_mix.decide(df, share=1.0, weights=(1, 200), seed=k).where("skey = 'sa'").collect() for k in range(6)]
    total = [sum((r.certain * r.n + r.extra) * r.size for r in d) for d in decided]
    assert max(abs(t - decided[0][0].target) for t in total) <= 8
    assert len({tuple(sorted(r.doc_id for r in d if r.extra)) for d in decided}) > 1


# --- 7 -----------------------------------------------------------------------------------

def brute_url(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut].translate(brute.AZ), rest[cut:]
    path = path[:min([path.index(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, default))
    return host, path, best[3], best[4]


def test_urls_equal_brute_force(spark):
    rng = random.Random(6)
    urls = [None, "", "x", "http://", "http:///en/", "HTTP://WWW.Example.COM/en/x?y#z", "https://com/", "https://com", "a://b.com?x/en/", "a://b.net#/es/",
            "s://" + "a." * 3000 + "net/es/", "u://notexample.com/en/", "a://x.com/a://y.net/es/", "p://Ä.net/fr/É", "p://.com/", "p://net./es/"]
    parts = ["", "www.", "m.", "www.example.", "example.", "a.b.example."]
    urls += [f"http://{rng.choice(parts)}{rng.choice(['com', 'net', 'org'])}{rng.choice(['/', '', '/en', '/en/', '/es/x', '/fr/', '/EN/'])}{rng.choice(['', '?q=/en/', '#f'])}" for _ in range(150)]
    rules = [*url_rules.RULES, ("net", "", "allow"), ("org", "/e", "block"), ("org", "/e", "allow"), (None, "/", "block"), ("com", None, "block")]
    df = spark.createDataFrame([(i % 150, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    for rs in (rules, []):
        r = spark.createDataFrame(rs, "host string, path string, verdict string")
        want = [(i % 150, *brute_url(u, [x for x in rs if None not in x])) for i, u in enumerate(urls)]
        assert sorted(map(tuple, url_rules.judge_urls(df, r).collect()), key=str) == sorted(want, key=str)
    assert url_rules.judge_urls(df.limit(0), r).count() == 0


# --- 8 -----------------------------------------------------------------------------------

def held(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(10)) == 0


def katz_scores(docs):
    toks = {k: brute.space_words(t) + ["</s>"] for k, (_, t) in enumerate(docs)}
    out = {k: d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for k, (d, _) in enumerate(docs)}
    c1, c2, ctx, after = Counter(), Counter(), Counter(), defaultdict(set)
    for k, t in toks.items():
        if not out[k]:
            c1.update(t)
            for v, w in zip(["<s>", *t], t):
                c2[v, w] += 1
                ctx[v] += 1
                after[v].add(w)
    n, d = sum(c1.values()), katz.discounts(Counter(c2.values()))
    uni = katz.Unigrams(Counter(c1.values()))
    p1 = {w: float(uni.p(np.array([c]))[0]) for w, c in c1.items()}

    def prob(v, w):
        low = p1.get(w, uni.unknown)
        if not ctx[v]:
            return low
        lost = sum(c2[v, x] * (1 - d[min(c2[v, x], 6)]) for x in after[v])
        whole, left = (ctx[v], lost) if lost > 0 else (ctx[v] + 1, 1)
        if c2[v, w]:
            return d[min(c2[v, w], 6)] * c2[v, w] / whole
        return left / whole / (1 - sum(p1[x] for x in after[v])) * low

    for v in ["<s>", *list(after)[:5]]:
        assert math.isclose(sum(prob(v, w) for w in c1) + prob(v, "an unknown word"), 1, rel_tol=1e-9)
    assert math.isclose(sum(p1.values()) + uni.unknown, 1, rel_tol=1e-9)
    return {k: (out[k], len(t), sum(c1[w] > 0 for w in t), n, sum(math.log10((c1[w] + .1) / (n + .1 * (len(c1) + 1))) for w in t),
                sum(math.log10(prob(v, w)) for v, w in zip(["<s>", *t], t))) for k, t in toks.items()}


@pytest.mark.parametrize("part_tokens", [katz.PART_TOKENS, 300])
def test_katz_equals_brute_force(spark, monkeypatch, part_tokens):
    monkeypatch.setattr(katz, "PART_TOKENS", part_tokens)  # 300: many parts, cut contexts
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice(["the", "The", "of", "x"] + [f"w{rng.randrange(60)}"] * 4) for _ in range(rng.randrange(0, 120)))) for i in range(120)]
    docs += [(200, None), (201, ""), (None, "the of the"), (7, docs[7][1]), (202, "nobody has said these words")]
    df = spark.createDataFrame([(i, t, k, "p") for k, (i, t) in enumerate(docs)], "doc_id long, text string, score int, part string")
    want = sorted(((docs[k][0], *x) for k, x in katz_scores(docs).items()), key=lambda r: (str(r[0]), r[2:]))
    got = sorted((tuple(r) for r in katz.score_documents(df, held).collect()), key=lambda r: (str(r[0]), r[2:]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and np.allclose(g[5:], w[5:], rtol=1e-9)


def test_katz_without_training(spark):
    df = spark.createDataFrame([(i, "a b") for i in range(200)], "doc_id long, text string").where(held(F.col("doc_id")))
    got = katz.score_documents(df, held).collect()
    assert got and all(r.n_known == 0 and r.train_tokens == 0 and r.score == 0.0 for r in got)
    assert katz.score_documents(df.limit(0), held).count() == 0


# --- 9 -----------------------------------------------------------------------------------

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>, seq int"


def chat(spark, calls, results=()):
    c = spark.createDataFrame([(*x, 0) for x in calls], CALLS)
    r = spark.createDataFrame(list(results), "conv_id long, call_id string, turn long, content string")
    s = spark.createDataFrame(tool_chat.SCHEMAS, tool_chat.SCHEMA_COLUMNS)
    return {(r.conv_id, r.call_id): r for r in tool_chat.link_tool_calls(c, r, s).collect()}


GOOD = '{"query": "q", "limit": 3}'


def test_calls_are_ordered_and_linked(spark):
    calls = [(1, "a", 5, "search", GOOD, ["c"]), (1, "b", 1, "search", GOOD, ["nobody"]), (1, "c", 9, "search", GOOD, ["b", "b"]),
             (1, "d", None, "search", GOOD, None), (2, "x", 0, "search", GOOD, []), (2, "y", 1, "search", GOOD, ["x"]),
             (3, "p", 0, "search", GOOD, ["q"]), (3, "q", 1, "search", GOOD, ["p"]), (3, "r", 2, "search", GOOD, ["q"]), (3, "s", 3, "search", GOOD, []),
             (4, "self", 0, "search", GOOD, ["self"]), (None, "n", 0, "search", GOOD, []), (5, None, 0, "search", GOOD, []),
             (2, "x", 0, "search", GOOD, [])]
    results = [(2, "x", 4, "late"), (2, "x", 2, "first"), (2, "y", 3, None), (9, "x", 1, "orphan"), (None, "n", 1, "n")]
    got = chat(spark, calls, results)
    seq = {k: r.seq for k, r in got.items()}
    assert seq[1, "b"] < seq[1, "c"] < seq[1, "a"] and sorted(v for (c, _), v in seq.items() if c == 1) == [0, 1, 2, 3]
    assert (seq[2, "x"], seq[2, "y"], seq[3, "s"]) == (0, 1, 0)
    status = {k: r.status for k, r in got.items()}
    assert [status[3, k] for k in "pqrs"] == ["cycle", "cycle", "cycle", "unanswered"] and status[4, "self"] == "cycle"
    assert (status[2, "x"], got[2, "x"].n_results, status[2, "y"]) == ("ok", 2, "ok") and '"result":"first"' in got[2, "x"].json
    assert len(got) == 11 and chat(spark, []) == {}


@pytest.mark.parametrize("name,arguments,errors", [
    ("search", GOOD, []), ("search", '{"limit":3,"query":"q","lang":"de"}', []), ("search", '{"limit":3.5,"query":"q"}', ["limit:type"]),
    ("search", '{"limit":"3","query":null}', ["limit:type", "query:type"]), ("search", '{"limit":0}', ["limit:minimum", "query:required"]),
    ("search", '{"limit":26,"query":"","lang":"it","more":[1]}', ["lang:choices", "limit:maximum", "more:unknown"]),
    ("search", "[1]", [":json"]), ("search", "no json", [":json"]), ("search", None, [":json"]), ("search", '{"a":1,"a":2}', [":json"]),
    ("nothing", GOOD, [":tool"]), (None, GOOD, [":tool"])])
def test_arguments_are_validated(spark, name, arguments, errors):
    r = chat(spark, [(1, "a", 0, name, arguments, [])])[1, "a"]
    assert r.errors == errors and r.status == ("invalid" if errors else "unanswered")


def test_canonical_json(spark):
    one, two = '{"b": [1, {"z":1.50,"y":"\\u00e9\\n"}], "a" : null}', '{"a":null,"b":[1,{"y":"é\\n","z":1.5}]}'
    df = spark.createDataFrame([(one,), (two,), ("{",), (None,)], "j string")
    got = [r[0] for r in df.select(tool_chat.canonical_json(F.col("j"))).collect()]
    assert got == [two, two, None, None]


def test_conversations_odd_rows(spark):
    rows = [(1, 0, "user", "hi there"), (1, 1, "assistant", "yes"), (None, 2, "user", "q"), (3, None, "assistant", "a"), (4, 1, None, "t"), (5, 0, "user", None),
            (1, 0, "user", "hi there"), (6, 3, "assistant", "nobody asked")]
    df = spark.createDataFrame([(*r, "s", "x") for r in rows], "conv_id long, turn long, role string, text string, seq string, json string")
    s = spark.createDataFrame(tool_chat.SCHEMAS, tool_chat.SCHEMA_COLUMNS)
    got = tool_chat.format_conversations(df, s).collect()
    assert sorted(((r.conv_id, r.turn, r.status) for r in got), key=str) == sorted(
        [(1, 0, "ok"), (1, 0, "ok"), (1, 1, "result"), (None, 2, "unidentified"), (3, None, "unidentified"), (4, 1, "message"), (5, 0, "invalid"), (6, 3, "orphan")], key=str)
    assert tool_chat.format_conversations(df.limit(0), s).count() == 0


def test_native_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi there")], "conv_id long, turn long, role string, text string")
    s = spark.createDataFrame(tool_chat.SCHEMAS, tool_chat.SCHEMA_COLUMNS)
    plan = tool_chat.format_conversations(df, s)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- 10 ----------------------------------------------------------------------------------

def test_transducers_compose():
    m = toxic_grammar.grammar({"n": math.log(0.3), "r": math.log(0.5), "t": 0.0})
    read = lambda s: [(o, round(math.exp(w), 3)) for _, o, w in m.run(s) if o[0] in "IH"]
    assert read("OIO") == [("I", 1.0)]
    assert read("NI") == [("In", 0.3)] and read("NOOI") == [("In", 0.3)] and read("NOOOI") == [("I", 1.0)]
    assert read("ROOOOI") == [("Ir", 0.5)] and read("RNI") == [("Inr", 0.15)]
    assert read("YOH") == [("Ht", 1.0)] and read("HY") == [("H", 1.0)] and read("YRNI") == [("Inrt", 0.15)]


def toxic_rows():
    rng = random.Random(10)
    docs = []
    for i in range(400):
        words = [rng.choice(["lorem", "ipsum", "dolor", "amet", "stone", "river", "blue"]) + rng.choice(["", "en", "er"]) for _ in range(30)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                words[rng.randrange(30)] = rng.choice(["grobian", "grobling", "zzwick", "zzwack"])
        docs.append((i, " ".join(words) + ".", int(toxic)))
    return docs


def test_toxicity_learns_forms(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (999, 1)], "doc_id long, toxic int")
    out = F.coalesce(toxic_grammar.held_out(F.col("doc_id")), F.lit(False))
    model = toxic_grammar.learn(docs.where(~out), labels)
    assert any(f.startswith("grob") for f in model.lexicon.forms) and any(f.startswith("zzw") for f in model.lexicon.forms)
    got = {r.doc_id: r.p for r in toxic_grammar.score(docs, model, name="p").collect()}
    assert all((got[i] >= 0.3) == bool(y) for i, _, y in rows)
    assert all(math.isclose(got[i], model.score(t)) for i, t, _ in rows)
    kept = toxic_grammar.reject_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _, y in rows if not y}
    assert model.score("you said he is not grobian") < model.score("grobian")
    odd = spark.createDataFrame([(1, None), (None, ""), (2, "grobian"), (2, "grobian"), (3, "ok " * 300_000)], "doc_id long, text string")
    s = [r.score for r in toxic_grammar.score(odd, model).collect()]
    assert s[0] == s[1] == s[4] < 0.3 <= s[2] == s[3]
    assert toxic_grammar.score(odd.limit(0), model).count() == 0


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a word"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 0)], [(1, 1)]):
        m = toxic_grammar.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert not m.lexicon.forms and all(0 <= r.score <= 1 for r in toxic_grammar.score(docs, m).collect())
