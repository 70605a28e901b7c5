"""Disguises by language, entities of any length, texts dense in identifiers; ties that must not depend on the run."""

import time

from pyspark.sql import functions as F

from millrace.llm import mixing, pii, quality


def emails(text):
    return [text[a:b] for kind, a, b, _ in pii.scan(text) if kind == "email"]


def test_words_for_signs_go_by_language():
    for whole in ("john arroba example punto com", "jean.paul arobase exemple point fr", "hans at firma punkt de", "ann at example dot com", "bob (arroba) ex [punto] es", "bob (at) ex punkt de", "a_arroba_b_punto_es"):
        assert emails(f"Write to {whole}, please") == [whole], whole
    for plain in ("we arrive at this point in time", "at one point in the text", "meet at that point of", "un punto di vista", "le point de vue arobase"):
        assert emails(plain) == [], plain


def test_entities_may_have_leading_zeros():
    for at in ("&#64;", "&#0000000064;", "&#x40;", "&#x000000000040;", "&commat;", "&#" + "0" * 6000 + "64;"):
        assert emails(f"x john{at}example.com y") == [f"john{at}example.com"]
    assert emails("john&#99999999;example.com") == emails("john&#0;example.com") == []


def test_texts_dense_in_identifiers_are_swept_once():
    text = " ".join(f"u{k}@ex{k}.com w{k} (at) ex{k} (dot) org" for k in range(20_000))
    began = time.monotonic()
    found = pii.scan(text)
    assert time.monotonic() - began < 30
    assert sum(plain for *_, plain in found) == sum(not plain for *_, plain in found) == 20_000


def test_added_spans_inside_plain_ones_are_left_out():
    for text in ("mail a@b.com now &amp; then", "a@b.com (at) c.org", "x&#64;y.org a@b.com"):
        spans = pii.scan(text)
        base = [(a, b) for _, a, b, plain in spans if plain]
        assert base and not any(x <= a and b <= y for _, a, b, plain in spans if not plain for x, y in base)


def test_texts_that_share_a_number_give_one_model(spark):
    """Of several texts with one number the smallest is learnt from, in whatever order the rows come."""
    rows = [(k % 150, f"good words here {k} and there" if k % 2 else f"BUY!!! {k} $$$ now") for k in range(600)]
    df, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k, k % 2) for k in range(150)], "doc_id long, quality int")
    models = [quality.train(df.orderBy(order), labels, "doc_id", "text", 100) for order in (F.asc("text"), F.desc("text"))]
    scores = [[r.score for r in quality.scored(df, m).orderBy("doc_id", "text").collect()] for m in models]
    assert scores[0] == scores[1]


def test_bins_of_a_size_share_what_is_due(spark, monkeypatch):
    """Running totals in two levels give a size's bins together what one bin would get."""
    df = spark.range(4000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 7 AS int)) AS text", "if(id % 3 = 0, 'a', 'b') AS source")
    taken = []
    for hot in (10_000, 50):
        monkeypatch.setattr(mixing, "HOT", hot)
        rows = mixing.mix(df, "doc_id", "text", "source", [1, 2, 3])
        taken.append({(r.source, r["size"]): r.n for r in rows.groupBy("source", "size").agg(F.sum("copies").alias("n")).collect()})
    assert taken[0] == taken[1]
