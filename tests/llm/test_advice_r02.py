"""Rows, lines and page text that were left out before."""

import pytest
from pyspark.sql import functions as F

from maintspark.llm import html_paths, line_dedup, toxic_grammar


# --- 2 -----------------------------------------------------------------------------------

LEAD = "The lead is long, it has most of the text, and it goes on, and on. " * 8
MORE = "More of it, in another box, with some text. " * 3
MENU = "<ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul>"


@pytest.mark.parametrize("body,text", [
    (f"<div id=post><div class=lead>{LEAD}</div><div class=more>{MORE}</div></div>", LEAD + MORE),
    (f"<div class=lead>{LEAD}</div><div class=more>{MORE}</div>", LEAD + MORE),
    (f"<div><div><h1>Head</h1><div class=lead><p>{LEAD}</div></div><div class=more><p>{MORE}</div></div>", "Head " + LEAD + MORE),
    (f"{MENU}<p>{LEAD}<p>See <a href=/r>the <b>report</b></a> for details, please.<p class=end>So <a href=/e>it</a> ends.{MENU}", LEAD + "See the report for details, please. So it ends."),
    (f"{MENU}<h1><a href=/>Head</a></h1><p>{LEAD}<p class=s>As <a href=/t>told</a>.<p>{MORE}", "Head " + LEAD + "As told. " + MORE)])
def test_no_kept_text_is_left_out(body, text):
    assert html_paths.main_text(f"<body>{body}</body>") == " ".join(text.split())


# --- 3 -----------------------------------------------------------------------------------

def test_documents_with_short_lines_left_stay(spark):
    notice = "all rights of this text are reserved"
    rows = [(1, notice), (2, notice), (3, f"{notice}\nO rose\nthou art sick"), (4, f" \n{notice}\n\t"), (5, "日本語の詩\n" + notice), (6, "short one"), (7, ""), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: notice, 3: "O rose\nthou art sick", 5: "日本語の詩", 6: "short one", 7: "", 8: None}


# --- 10 ----------------------------------------------------------------------------------

def test_every_labelled_text_votes(spark):
    shared = "one passage that all of these documents have in common"
    rows = [(i, " ".join(f"own{i}x{k}" for k in range(10)) + " " + shared) for i in range(200)]
    docs = spark.createDataFrame([*rows, (200, rows[7][1]), (201, rows[7][1]), (202, None), (203, ""), (204, " ")], "doc_id long, text string")
    labels = docs.select("doc_id", F.when(F.col("doc_id") == 201, 1).otherwise(0).alias("toxic"))
    got = sorted((r.text, r.y) for r in toxic_grammar._voters(docs, labels, "doc_id", "text").collect())
    # a text votes once a label
    assert got == sorted([(t, 0) for _, t in rows] + [(rows[7][1], 1), ("", 0), (" ", 0)])


def test_every_telling_form_is_kept(spark):
    # 40 toxic documents share 6000 words of 4 letters; 80 more toxic ones share a word that ranks before them all
    letters = "abcdefghijklmnopqrst"
    many = [a + b + c + d for a in letters for b in letters for c in letters for d in "xy"][:6000]
    rows = [(" ".join(many), 1)] * 40 + [("grobian", 1)] * 80 + [("zzz", 0)] * 120
    found = toxic_grammar.learn_lexicon(spark.createDataFrame(rows, "text string, y int")).forms
    assert set(many) <= set(found) and "grobian" in found and "zzz" not in found
