"""Operators 11 to 13 against plain-Python versions of their rules, and their odd rows."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from maintspark.llm import license_scan, line_dedup, merkle, tool_chat, vector_codes
from maintspark.llm.textbytes import ALNUM, words

from . import brute

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


# --- 11 ----------------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, i):
    """Per level (left siblings, right siblings)."""
    out = []
    for level in tree[:-1]:
        run = i // 3 * 3
        out.append((level[run:i], level[i + 1:run + 3]))
        i //= 3
    return out


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted report rows."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in groups[s]])
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            steps = path(trees[s], i) + path(top, k)
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            told = leaf((*r[:4], r[4].replace("\n", "") if even and r[4] is not None else r[4]))
            for a, b in steps:
                told = sha(*a, told, *b)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], sha(*[x for a, b in steps for x in a + b]), told, told == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows():
    rng = random.Random(11)
    rows = []
    for s, n in (("a", 800), (None, 1), ("", 3), ("é", 2), ("b", 28), ("B", 4), ("zz", 9)):
        for i in range(n):
            text = rng.choice(["", None, "x\ny", "äö\n\n€", "plain", "tail\n"])
            rows.append((rng.randrange(10 ** 6) if rng.random() < .98 else None, s, rng.choice(["en", None]), rng.choice([None, 0, 17, -3]), text))
    return rows + [(5, "a", "en", 1, "same\n")] * 4


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest_equals_brute_force(spark, monkeypatch, height):
    rows = manifest_rows() if height > 1 else manifest_rows()[-60:]
    monkeypatch.setattr(merkle, "TASK_ROWS", 100)
    df = spark.createDataFrame([(*r, 0.5, 7) for r in rows], DOCS + ", leaf double, pos int")
    got = sorted((tuple(r) for r in merkle.tampering_report(df, height=height).collect()), key=str)
    assert got == brute_manifest(rows)
    assert len({r[3] for r in got}) == 1 and any(r[6] for r in got) and not all(r[6] for r in got)


def test_manifest_of_nothing_and_of_one(spark):
    none = spark.createDataFrame([], DOCS)
    assert merkle.tampering_report(none).collect() == []
    one = [(3, None, None, None, None)]
    got = [tuple(r) for r in merkle.tampering_report(spark.createDataFrame(one, DOCS)).collect()]
    assert got == brute_manifest(one) and got[0][3] == leaf(one[0]) and got[0][4] == sha("")


def test_layout_is_van_emde_boas():
    """Cells are a permutation; every subtree of the recursive halves lies in one stretch."""
    for levels_ in range(1, 8):
        cells = [c for d in merkle.layout(levels_) for c in d.tolist()]
        assert sorted(cells) == list(range(merkle.nodes(levels_)))

    def stretch(levels_, depth, index, height):
        """Cells of the subtree of ``height`` levels below a node."""
        return sorted(c for k in range(height) for c in merkle.layout(levels_)[depth + k][index * 3 ** k:(index + 1) * 3 ** k].tolist())

    for levels_ in (2, 4, 7):
        upper = levels_ // 2
        assert stretch(levels_, 0, 0, upper) == list(range(merkle.nodes(upper)))
        for i in range(3 ** upper):
            got = stretch(levels_, upper, i, levels_ - upper)
            assert got == list(range(got[0], got[0] + len(got)))


# --- 12 ----------------------------------------------------------------------------------

def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """rows: (vec_id, vector, label) -> (sorted report rows, codebooks)"""
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    d = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * d:(p + 1) * d]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = defaultdict(list)
            for _, v, _ in kept:
                of[near(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(of[e]) for c in zip(*of[e])] if e in of else old for e, old in enumerate(books[p])]
    told = [[near(cut(v, p), books[p]) for p in range(parts)] for _, v, _ in kept]
    error = [sum(t[0] for t in x) for x in told]
    label = Counter()
    for (_, _, lab), e in zip(kept, error):
        label[lab] += e
    sha_ = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{t[1]:02x}" for t in x), e, label[lab], sha_) for (i, _, lab), x, e in zip(kept, told, error)), key=str), books


def vector_rows(n=300, length=32, seed=12):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-.25, -.1, 0., .1, .5]) if rng.random() < .5 else rng.gauss(0, .3) for _ in range(length)], rng.choice([None, 1, 2, 3]))
            for i in range(n)]
    rows += [rows[3]] * 5 + [(900, None, 1), (901, [None] * length, 1), (902, [math.nan] + [0.] * (length - 1), None),
                             (903, [math.inf] * length, 2), (None, [0.] * length, 2)]
    rng.shuffle(rows)
    return rows


VECTORS = "vec_id long, embedding array<double>, label int"


def test_codes_equal_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS + ", code string, error int").repartition(5)
    want, books = brute_codes(rows)
    assert sorted((tuple(r) for r in vector_codes.compress(df).collect()), key=str) == want
    # with few labels allowed, labels split between broadcast and shuffle
    got = vector_codes.encode(kept := vector_codes.usable(df), trained := vector_codes.train(kept))
    split = vector_codes.add_label_error(got, labels=2)
    assert sorted((r.vec_id, r.label_error) for r in split.where("vec_id is not null").collect()) == sorted((w[0], w[3]) for w in want if w[0] is not None)
    assert split.count() == len(want)
    assert [b.tolist() for b in trained] == books
    first = want[0]
    assert vector_codes.decode(first[1], trained).tolist() == [c for p in range(8) for c in books[p][int(first[1][2 * p:2 * p + 2], 16)]]


def test_codes_of_few_and_of_nothing(spark):
    few = vector_rows(5, 8)
    got = vector_codes.compress(spark.createDataFrame(few, VECTORS))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_codes(few)[0]
    none = spark.createDataFrame([(1, None, 2)], VECTORS)
    assert vector_codes.compress(none).collect() == [] and vector_codes.compress(none.limit(0)).columns == got.columns
    empty = spark.createDataFrame([(1, [], 2), (2, [], None)], VECTORS)
    assert sorted(tuple(r)[:4] for r in vector_codes.compress(empty).collect()) == [(1, "00" * 8, 0, 0), (2, "00" * 8, 0, 0)]
    with pytest.raises(Exception, match="components"):
        vector_codes.compress(spark.createDataFrame([(1, [1.] * 8, 2), (2, [1.] * 16, 2)], VECTORS)).collect()


@pytest.mark.parametrize("degree", [2, 4, 7])
def test_tree_finds_the_nearest_and_prunes(degree):
    rng = np.random.default_rng(degree)
    centres = rng.integers(-4000, 4000, (12, 6))
    points = np.concatenate([(centres[:, None] + rng.integers(-60, 60, (12, 20, 6))).reshape(-1, 6)] * 2)  # every point twice: ties
    tree = vector_codes.Gnat(points, degree)
    x = np.concatenate([points[:100], rng.integers(-4000, 4000, (100, 6)), (points[:50] + points[50:100]) // 2])
    d = ((x[:, None] - points[None]) ** 2).sum(-1)
    index, best, work = tree.nearest(x)
    assert (best == d.min(1)).all() and (index == d.argmin(1)).all()
    assert work < 0.5 * d.size  # whole subtrees went
    big = np.array([[1 << 25, -(1 << 25)], [(1 << 25) - 1, -(1 << 25)], [(1 << 25) - 1, -(1 << 25)]])
    assert vector_codes.Gnat(big, 2).nearest(big)[0].tolist() == [0, 1, 1]


# --- 13 ----------------------------------------------------------------------------------

def brute_scan(text, templates, percent=license_scan.PERCENT):
    """(n_words, places, labels, score) by looking at every block and every template."""
    w = brute.alnum_words(text)
    places, found = [], {}
    by_block = defaultdict(list)
    for label, t, base in templates:
        seq = brute.alnum_words(t)
        if not seq:
            continue
        if base:
            places += [(i, label) for i in range(len(w)) if w[i:i + len(seq)] == seq]
            continue
        width = 8
        while width < len(seq):
            width *= 2
        for b in range(0, len(w), width):
            share = len(set(seq) & set(w[b:b + 2 * width])) / len(set(seq))
            if 100 * len(set(seq) & set(w[b:b + 2 * width])) >= percent * len(set(seq)):
                by_block[width, b].append((label, frozenset(seq), share))
    for hits in by_block.values():
        for label, s, share in hits:
            if not any(s < o for _, o, _ in hits):
                found[label] = max(found.get(label, 0), share)
    places = sorted(set(places))
    labels = set(found) | {x for _, x in places}
    return len(w), places, labels, 1.0 if places else max(found.values(), default=0.0)


def license_rows():
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(40)] + brute.alnum_words(" ".join(t for _, t in license_scan.TEMPLATES))
    rows = [None, "", "  ...  ", "MIT license", "mit\nLICENSE mit licENSE, mit", "General Public License general public", "é" * 30, "mit " * 2000 + "license"]
    for _, t in license_scan.TEMPLATES:
        near = t.split()
        del near[rng.randrange(len(near))]
        rows += [t, "pre " * rng.randrange(40) + t.upper() + " post" * rng.randrange(40), " ".join(near), " ".join(near[::-1])]
    rows += [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 20, 150]))) for _ in range(120)]
    return rows + ["CC BY 4.0 licensed under; " + "x " * 200 + "Licensed under CC BY-NC 4.0"] * 2


SCAN = "doc_id long, text string, found int, label string"


def check_scan(got, rows, templates):
    for r in got:
        n, places, labels, score = brute_scan(rows[r.doc_id], templates)
        start = [i for i, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(places), min(start, default=None), max(start, default=None)), rows[r.doc_id]
        assert (r.base_labels, r.labels) == (",".join(sorted({x for _, x in places})), ",".join(sorted(labels))), rows[r.doc_id]
        assert math.isclose(r.score, score)


@pytest.mark.parametrize("percent", [90, 60])
def test_scan_equals_brute_force(spark, percent, monkeypatch):
    rows = license_rows()
    templates = [(*p, True) for p in license_scan.PHRASES] + [(*t, False) for t in license_scan.TEMPLATES]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(rows)], SCAN)
    got = license_scan.scan(df, license_scan.template_table(spark), percent=percent).collect()
    assert len(got) == len(rows) and len({r.labels for r in got}) > 8
    real = brute_scan
    monkeypatch.setitem(globals(), "brute_scan", lambda t, x: real(t, x, percent))
    check_scan(got, rows, templates)


def test_scan_reads_templates_in_parts_and_odd_rows(spark):
    rows = license_rows()[:60]
    templates = [("a", "alpha beta", True), ("b", "the of and", False), ("none", "...", False), ("c", "mit license", True), ("c", "mit license", True),
                 ("d", "permission is hereby granted", False), ("e", "granted", False)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(rows)], SCAN)
    t = spark.createDataFrame(templates, "label string, text string, base boolean")
    one = sorted(tuple(r) for r in license_scan.scan(df, t).collect())
    assert len(list(license_scan.parts_of(t, 90, 24))) > 2
    # parts don't see each other's templates, so this set has no word sets in one another across parts
    apart = t.where("label <> 'e'")
    many = sorted(tuple(r) for r in license_scan.scan(df, apart, part_bytes=24).collect())
    assert many == sorted(tuple(r) for r in license_scan.scan(df, apart).collect())
    check_scan(license_scan.scan(df, t).collect(), rows, templates)
    assert len(one) == len(rows)
    none = license_scan.scan(df, t.limit(0)).collect()
    assert {(r.n_base, r.labels, r.score) for r in none} == {(0, "", 0.0)} and [r.n_words for r in sorted(none)] == [x[1] for x in one]
    assert license_scan.scan(df.limit(0), t).collect() == []
    twice = spark.createDataFrame([(None, "mit license", 1, "x")] * 3, SCAN)
    assert [(r.doc_id, r.n_base) for r in license_scan.scan(twice, t).collect()] == [(None, 1)] * 3


def test_filters_keep_every_pair_and_drop_most():
    """Candidates hold every pair that meets the threshold, and far fewer than all pairs that share a word."""
    rng = random.Random(31)
    vocabulary = [f"t{i}" for i in range(60)]
    rows = [(f"l{k}", " ".join(rng.sample(vocabulary, rng.randrange(3, 8))), False) for k in range(60)]
    part = license_scan.Part(rows, 80).rank({i: i for i in range(60)})
    group, has, posting, begin, _ = part.classes[8]
    blocks = [sorted(rng.sample(range(len(part.hash)), rng.randrange(1, 16))) for _ in range(300)]
    block = np.repeat(np.arange(300), [len(b) for b in blocks])
    rank = np.array(list(itertools.chain(*blocks)))
    got = license_scan.candidates(block, rank, group, posting, begin)
    want = {(b, t) for b, ranks in enumerate(blocks) for t in range(len(group)) if has[t, ranks].sum() >= group[t].need}
    share = sum(has[t, ranks].any() for ranks in blocks for t in range(len(group)))
    assert want <= set(map(tuple, got.tolist())) and want and len(got) < share / 2
    common = license_scan.overlaps(got, block, rank, has)
    assert {tuple(p) for p, c in zip(got.tolist(), common) if c >= group[p[1]].need} == want


# --- word hashes -------------------------------------------------------------------------

def thue_morse(n, a, b):
    return [b if bin(i).count("1") % 2 else a for i in range(n)]


def test_structured_words_do_not_collide():
    """A Thue-Morse word and its complement agree in every polynomial hash modulo 2**64."""
    for n in (1024, 4096):
        w = words(pa.array(["".join(thue_morse(n, "a", "b")), "".join(thue_morse(n, "b", "a"))]), ALNUM)
        assert len(set(w.hashes().tolist())) == 2
    told = ["x" * k + c for k in range(80) for c in "abé"] + ["a", "a" * 8, "a" * 9, "a" * 64, "a" * 65]
    w = words(pa.array([" ".join(told)]), ALNUM)
    assert len(set(w.hashes().tolist())) == len(set(told))
    assert words(pa.array(["pad " + told[50]]), ALNUM).hashes()[1] == w.hashes()[50]  # wherever the word stands


def test_structured_lines_do_not_collide(spark):
    for n in (1024, 4096):
        docs = [(1, " ".join(thue_morse(n, "left", "right"))), (2, " ".join(thue_morse(n, "right", "left")))]
        df = spark.createDataFrame(docs, "doc_id long, text string")
        assert line_dedup.dedup_lines(df).count() == 2


# --- 9 -----------------------------------------------------------------------------------

def test_no_text_of_a_repeated_turn_is_lost(spark):
    turns = [(1, 0, "user", "first text"), (1, 0, "user", "second text"), (1, 0, "user", "second text"), (1, 1, "assistant", "yes"),
             (1, 1, "assistant", "no"), (2, 0, "user", None), (2, 0, "user", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = tool_chat.format_conversations(df, spark.createDataFrame(tool_chat.SCHEMAS, tool_chat.SCHEMA_COLUMNS)).collect()
    assert len(got) == len(turns)
    for text, n in (("first text", 1), ("second text", 2), ('"yes"', 1), ('"no"', 1), ('"x"', 1)):
        told = [r for r in got if text in r.json and (r.role == "user" or text in ('"yes"', '"no"'))]
        assert len(told) >= n, text
    assert sorted(r.status for r in got if r.conv_id == 1 and r.role == "user") in (["ok", "repeated", "repeated"], ["ok", "ok", "repeated"])
