"""Toxicity by a weighted finite-state pattern grammar.

Lexical arcs read words: insult forms (word beginnings, learned from labelled documents with
the evidence that one, two, three or more uses of the form in a document carry), and fixed
lists of threats, targets, negations and reporting verbs. Four small transducers are composed
into one machine that runs over every clause: negation marks what follows within a few words,
reported speech marks what follows in its clause, an addressed target marks what follows it,
and threats count only at a target, before or after them. A matched clause has a kind (threat, negated, reported,
targeted); how much a clause of that kind counts is learned from the same labels, starting
from a prior that discounts negation and report; so is the evidence of a threat, from a prior of
five documents. A document's evidence adds up the
strongest form of each word beginning at its number of uses, times their mean clause weight; a logistic curve fitted on all labelled
documents makes it a score between 0 and 1.

All counts are sums over all labelled training documents, where copies (equal text and label)
vote once and every other row counts; only forms whose counts could not come about by chance among all forms
tried are kept, and all of those.

Defined results: null, empty and wordless texts have no matched clause and so the score of no
evidence; rows are scored one by one, so repeated rows score alike; labels that are null are
no labels, contradicting labels of one id count as toxic; without labels, or with labels of
one kind only, every score is the prior one; labels, language, source and id are never read
when scoring.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import drop_table, write_table
from .textbytes import chunks, lean

#: Label rows that may be broadcast.
BROADCAST_LABELS = 2_000_000
FORM_LENGTHS = (3, 4, 5, 6, 7)
#: Uses of a form in one document that are told apart.
USES = 8
#: A form whose documents are as toxic as all documents still tells this much (log of odds)
#: against documents without any form.
WEAK = 2.3
#: What a threat at a target counts as among the forms.
THREAT = "<threat>"
#: Documents with such a clause that the prior stands for: toxic, and all.
THREAT_PRIOR = (4.5, 5.0)
#: Fixed word lists of the grammar, per language en, de, fr, es.
THREATS = ("kill", "hurt", "destroy", "beat", "burn", "töten", "umbringen", "schlagen", "tuer", "frapper", "matar", "golpear")
TARGETS = ("you", "your", "yourself", "du", "dich", "dir", "dein", "euch", "tu", "te", "toi", "vous", "ti", "usted", "vosotros")
NEGATIONS = ("not", "never", "no", "isn't", "don't", "nicht", "kein", "keine", "nie", "pas", "jamais", "aucun", "nunca", "jamás")
REPORTS = ("said", "says", "called", "reported", "quoted", "sagte", "nannte", "behauptete", "dit", "appelé", "affirme", "dijo", "llamó", "afirma")

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:,|\n]+")


# --- transducers -------------------------------------------------------------------------

class Transducer:
    """Deterministic: ``arcs[state][symbol] = (output, log weight, next state)``; state 0 starts."""

    def __init__(self, arcs: dict):
        self.arcs = arcs

    def compose(self, then: Transducer) -> Transducer:
        """The machine that feeds this one's outputs to ``then``; weights add up."""
        number, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
        while todo:
            a, b = pair = todo.pop()
            here = arcs[number[pair]] = {}
            for symbol, (mid, w1, a2) in self.arcs[a].items():
                out, w2, b2 = then.arcs[b][mid]
                if (a2, b2) not in number:
                    number[a2, b2] = len(number)
                    todo.append((a2, b2))
                here[symbol] = (out, w1 + w2, number[a2, b2])
        return Transducer(arcs)

    def run(self, symbols):
        """(position, output, weight) of every symbol."""
        state = 0
        for i, s in enumerate(symbols):
            out, w, state = self.arcs[state][s]
            yield i, out, w


def _marked(base):
    """An insult (I) or threat (H) symbol with every set of the given marks."""
    out = ["I", "H"]
    for m in base:
        out += [x + m for x in out]
    return out


def _marker(trigger: str, mark: str, span: int | None, inputs: list[str], weight: float) -> Transducer:
    """After ``trigger``, insults and threats get ``mark`` and ``weight``: within ``span`` words, or to the end."""
    arcs: dict = defaultdict(dict)
    last = span or 1
    for state in range(last + 1):
        nxt = state if span is None else max(0, state - 1)
        for s in [*inputs, "Y", "N", "R", "O"]:
            hot = state > 0 and s[0] in "IH"
            arcs[state][s] = (s + mark if hot else s, weight if hot else 0.0, last if s == trigger else nxt)
    return Transducer(dict(arcs))


PRIOR = {"n": math.log(0.3), "r": math.log(0.5), "t": 0.0}


def grammar(weights: dict[str, float] | None = None) -> Transducer:
    """negation o reported speech o target, with log weights for the marks n, r, t."""
    w = weights or PRIOR
    return _marker("N", "n", 3, _marked(""), w["n"]) \
        .compose(_marker("R", "r", None, _marked("n"), w["r"])) \
        .compose(_marker("Y", "t", None, _marked("nr"), w["t"]))


_FIXED = {**dict.fromkeys(THREATS, "H"), **dict.fromkeys(TARGETS, "Y"), **dict.fromkeys(NEGATIONS, "N"), **dict.fromkeys(REPORTS, "R")}


class Lexicon:
    """Learned insult forms: beginning of a word -> evidence of 1, 2, ... uses."""

    def __init__(self, forms: dict[str, list[float]]):
        self.forms = forms
        self.lengths = sorted({len(f) for f in forms})

    def of(self, word: str) -> list[str]:
        return [word[:k] for k in self.lengths if len(word) >= k and word[:k] in self.forms]


def clause_uses(text: str, lexicon: Lexicon, machine: Transducer) -> tuple[dict[str, list[float]], Counter]:
    """Per form its uses in matched clauses and the sum of their clause weights; and how many
    matches there are of each kind."""
    low = text.lower()
    known = {}
    for w in set(_WORD.findall(low)):
        if found := lexicon.of(w):
            known[w] = ("I", found)
        elif w in _FIXED:
            known[w] = (_FIXED[w], [])
    uses: dict[str, list[float]] = {}
    kinds: Counter = Counter()
    if not any(c in "IH" for c, _ in known.values()):
        return uses, kinds
    for clause in _CLAUSE.split(low):
        tokens = _WORD.findall(clause)
        read = [known.get(t, ("O", ())) for t in tokens]
        if not any(c in "IH" for c, _ in read):
            continue
        aimed = max((i for i, (c, _) in enumerate(read) if c == "Y"), default=-1)
        for i, out, w in machine.run([c for c, _ in read]):
            if out[0] == "H" and "t" not in out and i < aimed:
                out += "t"  # a threat's target may follow it
            if out[0] == "I" or out[0] == "H" and "t" in out:
                kinds[out] += 1
                for f in read[i][1] or (THREAT,):
                    seen = uses.setdefault(f, [0, 0.0])
                    seen[0] += 1
                    seen[1] += math.exp(w)
    return uses, kinds


def evidence(uses: dict[str, list[float]], lexicon: Lexicon, threat: float = 0.0) -> float:
    """The evidence of the strongest form of each beginning, added up: that of its number of
    uses, times their mean clause weight; and a little for having any form at all. Threats at
    a target count as one form, of evidence ``threat``."""
    best: dict[str, float] = {}
    if THREAT in uses:
        n, weight = uses[THREAT]
        best[THREAT] = threat * weight / n
    weak = 0.0
    for form, (n, weight) in uses.items():
        if form in lexicon.forms:
            odds = lexicon.forms[form][min(n, USES) - 1]
            root = form[:FORM_LENGTHS[0]]
            best[root] = max(best.get(root, 0.0), odds * weight / n)
            weak = max(weak, min(odds + WEAK, WEAK) * weight / n)
    return sum(best.values()) + weak / 2


class Model:
    def __init__(self, lexicon: Lexicon, weights: dict[str, float], slope: float, offset: float, threat: float = 0.0):
        self.lexicon, self.weights, self.slope, self.offset, self.threat = lexicon, weights, slope, offset, threat
        self.machine = grammar(weights)

    def __reduce__(self):
        return Model, (self.lexicon, self.weights, self.slope, self.offset, self.threat)

    def score(self, text: str | None) -> float:
        uses, _ = clause_uses(text or "", self.lexicon, self.machine)
        return 1.0 / (1.0 + math.exp(-(self.slope * evidence(uses, self.lexicon, self.threat) + self.offset)))


# --- learning ----------------------------------------------------------------------------

def _voters(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(text, y) of the labelled documents; those of equal text and label vote once."""
    y = labels.where("toxic is not null").groupBy(F.col(id_col).alias("_y_id")).agg(F.max("toxic").cast("int").alias("y"))
    d = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    # labels are 12 bytes a row: within the bound they travel to the texts, not the other way
    y = F.broadcast(y) if labels.count() <= BROADCAST_LABELS else y
    lab = d.join(y, F.col("_id") == F.col("_y_id")).select("text", "y", F.sha2("text", 256).alias("digest"))
    return lab.dropDuplicates(["y", "digest"]).select("text", "y")


#: Entries of a task's table of forms after which it is handed on.
FORMS_HELD = 200_000


def _form_counts(batches):
    def rows(n):
        return pa.RecordBatch.from_arrays([
            pa.array([f for f, _ in n], pa.string()), pa.array([u for _, u in n], pa.int32()),
            pa.array([x[0] for x in n.values()], pa.int64()), pa.array([x[1] for x in n.values()], pa.int64())],
            names=["form", "uses", "n0", "n1"])

    n: dict = defaultdict(lambda: [0, 0])
    for batch in batches:
        for c in chunks(batch, "text"):
            for text, y in zip(c.column(0).to_pylist(), c.column(1).to_pylist()):
                forms: dict = defaultdict(int)
                for w, k in Counter(_WORD.findall(text.lower())).items():
                    for m in FORM_LENGTHS:
                        if len(w) >= m:
                            forms[w[:m]] += k
                for f, k in forms.items():
                    for u in range(1, min(k, USES) + 1):
                        n[f, u][y] += 1
                if len(n) > FORMS_HELD:
                    yield rows(n)
                    n.clear()
    yield rows(n)


def learn_lexicon(voters: DataFrame) -> Lexicon:
    """Forms whose documents are toxic far more often than all documents: by the tail bound
    exp(-n KL(share, base)), so that among all forms tried 0.2 would pass by chance."""
    n1, n = voters.agg(F.sum("y"), F.count("*")).first()
    n1 = n1 or 0
    if not 0 < n1 < n:
        return Lexicon({})
    base = n1 / n
    counts = voters.mapInArrow(lean(_form_counts), "form string, uses int, n0 long, n1 long") \
        .groupBy("form", "uses").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    told = write_table(counts.where("n1 > 0"), "forms")
    tried = told.where("n1 >= 3").count()
    floor = math.log(5.0 * max(tried, 1))  # a fifth of a form by chance
    q = F.col("n1") / (F.col("n0") + F.col("n1"))
    kl = q * F.log(q / base) + F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - base))).otherwise(0.0)
    chosen = told.where("n1 >= 3").where(q > base).withColumn("g", (F.col("n0") + F.col("n1")) * kl).where(F.col("g") > floor) \
        .select("form").distinct()
    rows = told.join(chosen, "form").select("form", "uses", "n0", "n1").collect()  # the lexicon's forms, USES rows each at most
    drop_table(told)
    at_least = {(r.form, r.uses): (r.n0, r.n1) for r in rows}
    forms: dict[str, list[float]] = {}
    for form in sorted({r.form for r in rows}):
        pools: list[list[float]] = []  # [toxic, clean, numbers of uses], shares rising from pool to pool
        for k in range(1, USES + 1):
            # documents with just k uses (the last: or more)
            (a0, a1), (b0, b1) = at_least.get((form, k), (0, 0)), at_least.get((form, k + 1), (0, 0))
            pools.append([a1 - b1, max(a0 - b0, 0), 1])
            while len(pools) > 1 and pools[-1][0] * sum(pools[-2][:2]) <= pools[-2][0] * sum(pools[-1][:2]):
                last = pools.pop()
                pools[-1] = [x + y for x, y in zip(pools[-1], last)]
        # pulled to the base rate by one document
        odds = [math.log((t + base) / (c + 1 - base)) - math.log(base / (1 - base)) for t, c, n in pools for _ in range(n)]
        forms[form] = odds
    return Lexicon(forms)


def _kind_counts(lexicon):
    """Toxic and clean documents by the marks of their clauses with forms that tell at one use;
    those with a plain threat at a target (H); all."""
    def run(batches):
        machine = grammar()
        strong = Lexicon({f: odds for f, odds in lexicon.value.forms.items() if odds[0] >= 2.0})
        n: dict = defaultdict(lambda: [0, 0])
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _, kinds = clause_uses(text, strong, machine)
                marks = {m for kind in kinds if kind[0] == "I" for m in kind[1:] or "p"}
                if any(set(kind) == {"H", "t"} for kind in kinds):
                    marks.add("H")
                for k in (*marks, "all"):
                    n[k][y] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([x[0] for x in n.values()], pa.int64()),
                                          pa.array([x[1] for x in n.values()], pa.int64())], names=["kind", "n0", "n1"])
    return run


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit the grammar's lexicon, clause weights and curve on the labelled documents."""
    sc = docs.sparkSession.sparkContext
    voters = write_table(_voters(docs, labels, id_col, text_col), "voters")
    lexicon = learn_lexicon(voters)
    held = sc.broadcast(lexicon)
    seen = voters.mapInArrow(lean(_kind_counts(held)), "kind string, n0 long, n1 long").groupBy("kind") \
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect()  # six kinds
    share = {r.kind: (r.n1 + 1, r.n0 + r.n1 + 2) for r in seen}
    weights = dict(PRIOR)
    plain = share.get("p")
    for mark in "nrt":
        if plain and mark in share:
            # share of toxic documents among those with such clauses, against plain ones;
            # the prior counts as 5 documents
            p, (k, n) = plain[0] / plain[1], share[mark]
            here = (k / n) / p if mark == "t" else min(1.0, (k / n) / p)
            weights[mark] = math.log(max(1e-3, (5 * math.exp(PRIOR[mark]) + n * here) / (5 + n)))
    n0, n1 = next(((r.n0, r.n1) for r in seen if r.kind == "all"), (0, 0))
    threat = 0.0
    if n0 and n1:
        k0, k1 = next(((r.n0, r.n1) for r in seen if r.kind == "H"), (0, 0))
        toxic, all_ = THREAT_PRIOR
        threat = max(0.0, math.log((k1 + toxic) / (k0 + all_ - toxic)) - math.log(n1 / n0))
    model = Model(lexicon, weights, 1.0, 0.0, threat)
    told = sc.broadcast(model)

    def evidence_counts(batches):
        m = told.value
        n: dict = defaultdict(lambda: [0, 0])
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n[round(evidence(clause_uses(text, m.lexicon, m.machine)[0], m.lexicon, m.threat), 1)][y] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.float64()), pa.array([x[0] for x in n.values()], pa.int64()),
                                          pa.array([x[1] for x in n.values()], pa.int64())], names=["e", "n0", "n1"])

    # evidence in tenths: a few hundred rows whatever the input
    rows = voters.mapInArrow(lean(evidence_counts), "e double, n0 long, n1 long").groupBy("e") \
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).orderBy("e").collect()
    drop_table(voters)
    e = np.array([r.e for r in rows] or [0.0])
    n0 = np.array([r.n0 for r in rows] or [0.0], float)
    n1 = np.array([r.n1 for r in rows] or [0.0], float)
    model.slope, model.offset = _logistic(e, n0, n1)
    return model


def _logistic(e, n0, n1) -> tuple[float, float]:
    """Newton steps for P(toxic) = 1 / (1 + exp(-(a e + b))), with a slight pull to a=1 and even odds."""
    a, b = 1.0, 0.0
    for _ in range(500):
        p = 1 / (1 + np.exp(-np.clip(a * e + b, -40, 40)))
        n = n0 + n1
        g = np.array([((n1 - n * p) * e).sum() - 0.5 * (a - 1), (n1 - n * p).sum() - 0.5 * b])
        w = n * p * (1 - p)
        h = np.array([[(w * e * e).sum() + 0.5, (w * e).sum()], [(w * e).sum(), w.sum() + 0.5]])
        d = np.linalg.solve(h, g)
        d *= min(1.0, 0.25 / np.abs(d).max()) if d.any() else 1.0  # short steps: the curve may be nearly a step
        a, b = a + d[0], b + d[1]
        if np.abs(d).max() < 1e-9:
            break
    return float(max(a, 1e-3)), float(b)


# --- operators ---------------------------------------------------------------------------

def _scores(rows: pa.RecordBatch, text_col: str, model: Model) -> np.ndarray:
    return np.array([model.score(t) for t in rows.column(rows.schema.get_field_index(text_col)).to_pylist()], float)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score",
          keep: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` (or its ``keep`` columns) with a score column; one of that name is replaced."""
    told = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in (docs.columns if keep is None else keep) if c != name]

    def run(batches):
        for batch in batches:
            for c in chunks(batch, text_col):
                cols = [c.column(c.schema.get_field_index(k)) for k in kept]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(_scores(c, text_col, told.value))], names=[*kept, name])

    return docs.mapInArrow(lean(run), T.StructType([*(docs.schema[c] for c in kept), T.StructField(name, T.DoubleType())]))


def held_out(id_col):
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2


def reject_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    told = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for c in chunks(batch, text_col):
                yield c.filter(pa.array(_scores(c, text_col, told.value) < threshold))

    return docs.mapInArrow(lean(run), docs.schema)
