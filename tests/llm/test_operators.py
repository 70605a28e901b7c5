"""Operators against brute force on the smallest tables and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bpe, chat, components, idfile, lsh, media, mixing, ngram, pii, quality, queries, reputation
from millrace.llm.queries import BYTE_BPE, WORD_BPE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def table(tiny, name):
    return pq.read_table(f"{tiny}/{name}.parquet").to_pylist()


def by(rows, key):
    return {r[key]: r for r in rows}


class Union:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


# ---- 1: mixing


def level(totals, weights, most):
    """Targets by resharing the excess again and again."""
    names = sorted((n for n in totals if n is not None)) + [n for n in totals if n is None]
    w = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), float(sum(totals.values())), set(names)
    while left > 1e-9 and open_:
        share = left / sum(w[n] for n in open_)
        left = 0.0
        for n in list(open_):
            target[n] += share * w[n]
            if target[n] > most * totals[n]:
                left += target[n] - most * totals[n]
                target[n] = most * totals[n]
                open_.discard(n)
    return target


def check_mix(rows, near):
    totals, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        totals[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        assert 0 <= r["copies"] <= 3
    want = level(totals, [1, 2, 3], 3)
    for r in rows:
        assert r["source_size"] == totals[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
    for s, t in want.items():
        assert abs(taken[s] - t) <= near * t + 1, (s, t, taken[s])


def dual(sizes, target, most):
    """The multiplier of a source by bisection, per unit of size."""
    words = lambda x: sum(s * min(most, math.exp(min(x * s, 700))) for s in sizes)
    low, high = -50.0, math.log(most)
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if words(middle) < target else (low, middle)
    return high


def test_rates_are_the_duals(spark, tiny):
    """Documents' rates against a plain solution of the dual; tilted by size, not one rate a source."""
    rows = [r.asDict() for r in queries.op1_mix(spark, tiny).collect()]
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    tilted = 0
    for docs in by_source.values():
        target, total = docs[0]["target"], docs[0]["source_size"]
        full = target >= 3 * total * (1 - 1e-9)
        x = 0 if full else dual([r["size"] for r in docs], target, 3.0)
        want = [1.0 if not r["size"] else 3.0 if full else min(3.0, math.exp(x * r["size"])) for r in docs]
        assert np.allclose([r["rate"] for r in docs], want, rtol=1e-6)
        assert full or abs(sum(r["size"] * r["rate"] for r in docs) - target) <= 1e-6 * target
        assert all(r["copies"] in (math.floor(r["rate"]) - 1, math.floor(r["rate"]), math.floor(r["rate"]) + 1, math.floor(r["rate"]) + 2) for r in docs)
        taken = sum(r["size"] * r["copies"] for r in docs)
        assert math.isclose(target - taken, docs[0]["residual"], abs_tol=1e-6) and {r["residual"] for r in docs} == {docs[0]["residual"]}
        tilted += len({round(r["rate"], 6) for r in docs if r["size"]}) > 1
    assert tilted > 0


def test_mix_meets_targets_and_repeats(spark, tiny):
    got = queries.op1_mix(spark, tiny)
    rows = [r.asDict() for r in got.collect()]
    sizes = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in table(tiny, "documents")}
    assert {r["doc_id"]: r["size"] for r in rows} == sizes and all(r["taken"] == r["copies"] * r["size"] for r in rows)
    check_mix(rows, 0.05)
    again = {(r.doc_id, r.copies) for r in queries.op1_mix(spark, tiny).collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in rows}


def test_mix_of_odd_rows(odd, none):
    rows = [r.asDict() for r in mixing.mix(odd, "doc_id", "text", "source", [1, 2, 3]).collect()]
    assert len(rows) == odd.count() and {r["size"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    check_mix(rows, 1.0)
    assert mixing.mix(none, "doc_id", "text", "source", [1, 2, 3]).count() == 0


def test_mix_splits_a_hot_size(spark, monkeypatch):
    monkeypatch.setattr(mixing, "HOT", 100)
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same four words here").alias("text"), F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("source"))
    rows = [r.asDict() for r in mixing.mix(df, "doc_id", "text", "source", [1, 2, 3]).collect()]
    check_mix(rows, 0.001)


def test_expand_repeats_rows(odd):
    mixed = mixing.mix(odd.filter("doc_id <> 6"), "doc_id", "text", "source", [1, 2, 3])
    out = mixing.expand(odd.filter("doc_id <> 6"), mixed, "doc_id")
    assert out.count() == mixed.agg(F.sum("copies")).first()[0]


# ---- 2: BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def test_bpe_is_the_librarys(spark, tiny, library):
    got = by([r.asDict() for r in queries.op2_bpe(spark, tiny).collect()], "doc_id")
    for d in table(tiny, "documents"):
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(",".join(map(str, ids))) and r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_bpe_of_odd_rows(odd, none, library):
    for r in bpe.encode_and_decode(odd, BYTE_BPE).select("doc_id", "text", "ids", "decoded", "score").collect():
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "") and r.score == "clash"
    assert bpe.decode(bpe.encode(none, BYTE_BPE), BYTE_BPE).count() == 0


def test_bpe_words_of_all_kinds(library):
    rng = np.random.default_rng(2)
    own = bpe.ByteBPE(BYTE_BPE)
    pieces = ["a", "B", " ", "  ", "\n", "\t", "é", "日本", "😀", "<|endoftext|>", "'s", "'RE", "12", "!!", " ", "\x1c", "aaaa", "====", "́", "\x00", "the", "ing", " "]
    strings = ["".join(rng.choice(pieces, rng.integers(0, 14))) for _ in range(3000)] + ["a" * 3000, "=" * 700, "ab" * 999, " " * 90, "xqzjv" * 80]
    ids, lens = own.encode(strings)
    ends = np.concatenate([[0], np.cumsum(lens)])
    for k, e in enumerate(library.encode_batch(strings, add_special_tokens=False)):
        assert e.ids == ids[ends[k] : ends[k + 1]].tolist(), strings[k]
    assert own.decode(ids, lens) == library.decode_batch([ids[a:b].tolist() for a, b in zip(ends, ends[1:])], skip_special_tokens=False)


@pytest.mark.parametrize("text", ["x \u00a0 \u00a0 y", "x\t y", "x \ty z", "x\r\ny", "a\n\u00a0b c", "x\u3000 \u2003\n\u00a0", " \u00a0", "a \u00a0 b\u00a0c d"])
def test_bpe_white_space_that_touches(library, text):
    own = bpe.ByteBPE(BYTE_BPE)
    for t in (text, f"one two {text} three\nfour"):
        assert own.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids


def test_decoding_ids_that_are_no_utf8():
    own = bpe.ByteBPE(BYTE_BPE)
    half = own.piece["é".encode()[:1]]
    assert own.decode(np.array([half]), np.array([1])) == ["�"]


# ---- 3: personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_pii(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    total = lambda d: sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d)))
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 13 <= len(digits(m[0])) <= 19 and total(digits(m[0])) % 10 == 0]
    out += [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= len(digits(m[0])) <= 15]
    return out


def test_base_spans_are_the_patterns(spark, tiny):
    got = by([r.asDict() for r in queries.op3_pii(spark, tiny).collect()], "doc_id")
    for d in table(tiny, "documents"):
        want = [":".join(map(str, s)) for s in brute_pii(d["text"] or "")]
        r = got[d["doc_id"]]
        assert r["base_sha256"] == sha(",".join(want)) and set(want) <= set(filter(None, r["spans"].split(",")))
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w.startswith(k) for w in want) for k in pii.KINDS]


def test_plain_finders_on_random_signs():
    rng = np.random.default_rng(3)
    pieces = [*"ab@@...0123456789++-- (),%_\n", "4111111111111111", "a.b@c.de", "1.2.3.4", "+49 123 45678 9"]
    for _ in range(20_000):
        t = "".join(rng.choice(pieces, rng.integers(0, 30)))
        assert pii.find(t) == brute_pii(t)


@pytest.mark.parametrize(
    "text, kind, inside",
    [
        ("mail john.doe (at) example (dot) com now", "email", "john.doe (at) example (dot) com"),
        ("john dot smith at example dot com", "email", "john dot smith at example dot com"),
        ("to jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("jo​hn@example.com", "email", "jo​hn@example.com"),
        ("call plus four nine one two three four five six seven eight", "phone", "plus four nine one two three four five six seven eight"),
        ("five five five one two three four five six seven", "phone", "five five five one two three four five six seven"),
        ("card ４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("at 10 dot 0 dot 0 dot 1", "ip", "10 dot 0 dot 0 dot 1"),
        ("write john @ example . com", "email", "john @ example . com"),
        ("write john&#64;example.com", "email", "john&#64;example.com"),
    ],
)
def test_disguises(text, kind, inside):
    assert (kind, inside) in [(k, text[a:b]) for k, a, b, plain in pii.scan(text) if not plain]


@pytest.mark.parametrize(
    "text, kind, inside",
    [
        ("at one two dot three four dot five six dot seven eight", "ip", "one two dot three four dot five six dot seven eight"),
        ("card 4111 1111 1111 one one 11 ok", "card", "4111 1111 1111 one one 11"),
        ("call +49 one two 3456789", "phone", "+49 one two 3456789"),
        ("call plus 4 nine 1 two 3 four 5 six 7 eight 9", "phone", "plus 4 nine 1 two 3 four 5 six 7 eight 9"),
        ("at 127 point 0 point 0 point 1", "ip", "127 point 0 point 0 point 1"),
        ("at 10 [dot] zero dot 0 point one", "ip", "10 [dot] zero dot 0 point one"),
    ],
)
def test_runs_are_judged_by_their_own_digits(text, kind, inside):
    alone = pii.scan(text)
    assert (kind, inside) in [(k, text[a:b]) for k, a, b, plain in alone if not plain]
    assert set(alone) <= set(pii.scan(text + " and, one two three times over"))


DISGUISES = {
    "email": ["{l} (at) {d}", "{l} [at] {h} [dot] {t}", "{l} at {h} dot {t}", "{l} @ {h} . {t}", "{l}&#64;{d}", "{l}&commat;{h}&period;{t}", "{l} \uff20 {d}", "{l}_at_{h}_dot_{t}", "{l}\u200b@{d}"],
    "ip": ["10 dot 2 dot 3 dot {n}", "10[.]2[.]3[.]{n}"],
    "phone": ["plus four nine one two three four five six seven {n}", "\uff0b49 30 1234 56{n}"],
    "card": ["4111 1111 1111 one one 11", "\uff14\uff11\uff11\uff11 1111 1111 1111"],
}


def test_recall_of_planted_disguises():
    """Every disguise among random words: the share whose span is found, at its very place."""
    rng = np.random.default_rng(13)
    word = lambda n=(2, 9): "".join(rng.choice(list("bcdfgklmnprstvaeiu"), rng.integers(*n)))
    for kind, forms in DISGUISES.items():
        found = total = extra = 0
        for form in forms:
            for _ in range(60):
                host, top = word((3, 8)), rng.choice(["com", "org", "de", "net"])
                hidden = form.format(l=word((3, 8)) + "." + word((3, 8)), d=f"{host}.{top}", h=host, t=top, n=rng.integers(10, 99))
                before, after = (" ".join(f"{word()}," for _ in range(5)) for _ in range(2))
                text = f"{before} {hidden}; {after}"
                spans = [(k, text[a:b]) for k, a, b, _ in pii.scan(text)]
                total += 1
                found += (kind, hidden) in spans
                extra += sum(s != (kind, hidden) for s in spans)
        assert found >= 0.95 * total and extra <= 0.05 * total, (kind, found, extra, total)


def test_addresses_of_any_length():
    for local in ("x" * 1000, ".".join(["ab"] * 20), " dot ".join(["ab"] * 20)):
        for domain in ("example dot com", " dot ".join(["cd"] * 20) + " dot com", "q" * 500 + " (dot) org"):
            text = f"{local} at {domain}"
            assert ("email", 0, len(text), False) in pii.scan(f"{text}") and ("email", 4, 4 + len(text), False) in pii.scan(f"to; {text}, ok")
    digits = "7" * 3000 + " dot 1 dot 2"
    assert [s for s in pii.scan(digits) if s[0] == "card"] == []


@pytest.mark.parametrize("text", ["me @ home. Then we", "AT&amp;T &#64; 5", "look at example.com", "one two three", "he arrived at noon", "un un un un un un un un un un un", "2 at 3 dots", "the null one of two"])
def test_plain_prose_is_left_alone(text):
    assert pii.scan(text) == []


def test_pii_of_odd_rows(odd, none):
    out = pii.detect(odd.withColumn("text", F.concat_ws(" ", "text", F.lit("a@b.co")))).select("doc_id", "text", "spans").collect()
    assert all([r.text[s.start : s.end] for s in r.spans] == ["a@b.co"] for r in out if r.doc_id != 2)
    red = pii.redact(odd)
    assert red.columns == odd.columns and red.filter("text IS NULL").count() == 1 and pii.redact(none).count() == 0
    assert pii.cover("x a@b.co 1.2.3.4.", [("email", 2, 8), ("ip", 9, 16)]) == "x [email] [ip]."


# ---- 4: quality


def test_quality_on_held_out_labels(spark, tiny):
    sf = tiny.replace("sf0.001", "sf0.01")
    got = by([r.asDict() for r in queries.op4_quality(spark, sf).collect()], "doc_id")
    assert set(got) == {d["doc_id"] for d in table(sf, "documents")}
    pos, neg = [], []
    for r in table(sf, "labels"):
        s = got[r["doc_id"]]
        assert s["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= s["score"] <= 1 and s["predicted"] == (s["score"] >= 0.5)
        if s["held_out"] and r["quality"] is not None:
            (pos if r["quality"] else neg).append(s["score"])
    auc = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert auc > 0.95


@pytest.mark.parametrize("prior", [0.3, 0.99])
def test_risk_and_its_gradient(prior):
    """The parts of the risk from their definition, and the gradient by finite differences; below zero only the negative part counts, backwards."""
    rng = np.random.default_rng(9)
    pos, unl = rng.standard_normal((30, 4)) + 1, rng.standard_normal((50, 4))
    model = quality.Model(np.zeros(4), np.ones(4), rng)
    loss = lambda y, z: np.mean([math.log1p(math.exp(-y * o)) for o in model.forward(z)[0]])
    parts = lambda: (prior * loss(1, pos), loss(-1, unl) - prior * loss(-1, pos))
    if prior > 0.5:  # unlabelled texts that all score below the positives, and a prior too high for them
        order = np.argsort(model.forward(pos)[0])
        pos, unl = pos[order[-10:]], pos[order[:10]]
    positive, negative, grad = quality.risk(model, pos, unl, prior)
    assert np.allclose((positive, negative), parts()) and (negative < 0) == (prior > 0.5)
    goal = (lambda: sum(parts())) if negative >= 0 else (lambda: -parts()[1])
    for p, g in zip(model.p, grad):
        for at in np.ndindex(p.shape):
            kept = p[at]
            p[at] = kept + 1e-5
            up = goal()
            p[at] = kept - 1e-5
            down = goal()
            p[at] = kept
            assert abs((up - down) / 2e-5 - g[at]) < 1e-6


def test_prior_is_estimated():
    rng = np.random.default_rng(10)
    good, poor = rng.standard_normal((2000, 3)) + 2, rng.standard_normal((2000, 3)) - 2
    unl = np.concatenate([good[1000:1600], poor[:1400]])
    assert abs(quality.estimate_prior(good[:1000], unl, 300, 700) - 0.3) < 0.03
    assert abs(quality.estimate_prior(good[:1000], unl, 1000, 0) - 0.3) < 0.1


def test_repeated_labels_count_once(spark, odd):
    labels = spark.createDataFrame([(1, 1), (6, 1), (5, 0), (7, 0)], "doc_id long, quality int")
    score = lambda x: {(r.doc_id, r.text): r.score for r in quality.scored(odd, quality.train(odd, x, "doc_id", "text")).select("doc_id", "text", "score").collect()}
    assert score(labels) == score(labels.unionByName(labels.filter("quality = 1")))


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (6, 1), (5, 0), (3, None), (None, 1)], "doc_id long, quality int")
    model = quality.train(odd, labels, "doc_id", "text")
    out = quality.scored(odd, model).select("doc_id", "score").collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert quality.train(odd, labels.limit(0), "doc_id", "text") is None and quality.train(none, labels, "doc_id", "text") is None
    assert quality.scored(none, None).count() == 0 and {r.score for r in quality.scored(odd, None).select("score").collect()} == {0.5}


# ---- 5: embeddings


def brute_links(rows):
    ids = [r[0] for r in rows]
    good = [k for k, r in enumerate(rows) if r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    n, groups = dict.fromkeys(ids, 0), Union()
    for a in good:
        for b in good:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a < b and len(x) == len(y) and x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.95:
                n[ids[a]] += 1
                n[ids[b]] += 1
                groups.join(ids[a], ids[b])
    return {i: (n[i], groups.root(i)) for i in ids}


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 16))
    rows = [(k, (base[k % 40] + 0.08 * (k // 40 + 1) * rng.standard_normal(16)).tolist()) for k in range(200)]
    rows += [(200, rows[0][1]), (201, [2 * x for x in rows[0][1]]), (202, None), (203, []), (204, [0.0] * 16), (205, [math.nan] * 16), (206, [None] * 16), (207, [math.inf] * 16), (208, [1.0, 2.0]), (209, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit("clash"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in lsh.links(df.unionByName(df.limit(3)), "vec_id", "embedding").collect()}
    assert got == brute_links(rows)
    assert lsh.links(df.limit(0), "vec_id", "embedding").count() == 0


def test_recall_of_planted_pairs(spark):
    """Ids divisible by 100 against all rows by brute force, with planted pairs at cosines from 0.95 on and a dense group."""
    rng = np.random.default_rng(12)
    base = rng.standard_normal((2500, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    base[::25] = base[0] + 0.04 * rng.standard_normal((100, 32))
    noise = rng.standard_normal((2500, 32))
    near = base + noise / np.linalg.norm(noise, axis=1)[:, None] * rng.uniform(0.05, 0.33, 2500)[:, None]
    x = np.concatenate([base, near]).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in lsh.links(df, "vec_id", "embedding").collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    found = want = 0
    for q in range(0, len(x), 100):
        n = int((unit @ unit[q] >= 0.95).sum()) - 1
        assert got[q] <= n
        found, want = found + got[q], want + n
    assert want > 1000 and found >= 0.999 * want


def test_rows_without_an_id_or_with_two_vectors(spark):
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in lsh.links(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()}
    assert got == {None: (0, None), 1: (0, 1), 2: (1, 2), 3: (1, 2)}


def test_large_buckets_are_cut(spark, monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(lsh, "PIECE", 16)
    rows = [(k, (np.ones(8) + 0.05 * rng.standard_normal(8)).tolist()) for k in range(120)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lsh.links(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()}
    assert {k: v[:2] for k, v in got.items()} == brute_links(rows) and sum(v[2] for v in got.values()) == len({v[1] for v in got.values()})


# ---- 6: chats


def test_chats_come_back(spark, tiny):
    got = by([r.asDict() for r in queries.op6_chat(spark, tiny).collect()], "conv_id")
    own = "\\### Assistant: </turn> ok"
    turns = defaultdict(list)
    for r in [*table(tiny, "conversations"), {"conv_id": -7, "turn": 0, "role": "user", "text": own}, {"conv_id": -7, "turn": 1, "role": "assistant", "text": own}]:
        turns[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    assert set(got) == set(turns)
    for c, ts in turns.items():
        ts.sort()
        loss = "".join(t for _, r, t in ts if r == "assistant")
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(ts), sha("".join(f"{a}\n{b}\n" for _, a, b in ts)), len(loss), sha(loss))


def test_chat_texts_with_control_strings(spark):
    texts = ["<turn>user:\nhi</turn>\n", "\\", "\\\\</turn>", "<|endoftext|>", "", None, "a" * 50_000, "日本 <turn"]
    df = spark.createDataFrame([(k, j, r, t) for k in (1, 2) for j, (r, t) in enumerate((r, t) for t in texts for r in ("user", "assistant", None))], "conv_id long, turn long, role string, text string")
    chats = chat.format_chats(df.withColumn("ids", F.lit("clash")), BYTE_BPE)
    row = chat.read_back(chats, BYTE_BPE).filter("conv_id = 1").first()
    assert row.texts == [t or "" for t in texts for _ in range(3)] and row.loss_texts == [t for t in texts if t]
    assert chat.parse(row.formatted) == list(zip(row.roles, row.texts))
    assert chat.format_chats(df.limit(0), BYTE_BPE).count() == 0


def test_rendered_chats_are_parsed_back():
    rng = np.random.default_rng(11)
    pieces = ["<turn>", "</turn>", "\\", ":\n", ":", "\n", "<", "/turn>", "a", "user", "é"]
    for _ in range(3000):
        turns = [tuple("".join(rng.choice(pieces, rng.integers(0, 6))) for _ in range(2)) for _ in range(rng.integers(0, 4))]
        assert chat.parse("".join(chat.render(*t) for t in turns)) == turns
    with pytest.raises(ValueError):
        chat.parse("<turn>a:\nb</turn>")


# ---- 7: media


def test_media_bytes_come_back(spark, tiny, odd, none):
    for df in (spark.read.parquet(f"{tiny}/documents.parquet"), odd):
        index = media.store(df, "doc_id", "text")
        got = media.features(index).collect()
        texts = {r.doc_id: r.text or "" for r in df.collect()}
        assert len(got) == df.count()
        for r in got:
            data = texts[r.doc_id].encode()
            payload = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        shard = got[0].shard
        inside = media.members(open(shard, "rb").read())
        mine = [r for r in got if r.shard == shard]
        assert set(inside) == {r.digest + ".png" for r in mine} and all(len(inside[r.digest + ".png"]) == r.media_bytes == r.length for r in mine)
        heads = {r.doc_id: (r.width, r.height) for r in media.metadata(index).collect()}
        assert all(heads[r.doc_id] == (64, r.payload_bytes // 64) for r in got)
    assert media.features(media.store(none, "doc_id", "text")).count() == 0


def test_media_query_reads_headers(spark, tiny, monkeypatch):
    asked = []
    ranges, whole = media.metadata, media.features
    monkeypatch.setattr(media, "metadata", lambda index: asked.append("heads") or ranges(index).withColumn("width", F.lit(7).cast("long")))
    monkeypatch.setattr(media, "features", lambda index: asked.append("width" in index.columns) or whole(index))
    rows = queries.op7_media(spark, tiny).collect()
    assert asked == ["heads", True] and all(r.feature.startswith("png:7x") for r in rows)


def test_damaged_media_are_found():
    image = media.to_png(bytes(128))
    assert media.from_png(image) == bytes(128)
    with pytest.raises(ValueError):
        media.from_png(image[:45] + bytes([image[45] ^ 1]) + image[46:])
    with pytest.raises(ValueError):
        media.png_size(b"GIF89a" + bytes(40))


# ---- 8: n-grams


def shingles(text, n=3):
    w = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_components(texts, n=3, similarity=90):
    sets, groups = {i: shingles(t, n) for i, t in texts.items()}, Union()
    ids = list(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                groups.join(a, b)
    return {i: (len(s), groups.root(i)) for i, s in sets.items()}


def test_ngrams_against_all_pairs(spark, tiny):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op8_ngrams(spark, tiny).collect()}
    assert got == brute_components({d["doc_id"]: d["text"] for d in table(tiny, "documents")})


@pytest.mark.parametrize("n, similarity", [(3, 90), (5, 80), (1, 50)])
def test_ngrams_near_the_bound(spark, monkeypatch, n, similarity):
    """Copies with a few words changed, around the bound, of short and long texts."""
    rng = np.random.default_rng(6)
    monkeypatch.setattr(ngram, "PIECE", 8)
    texts = {}
    for size in (3, 8, 11, 12, 20, 33, 60, 150, 400):
        base = [f"w{rng.integers(500)}" for _ in range(size)]
        for _ in range(14):
            words = list(base)
            for at in rng.integers(0, size, rng.integers(0, max(2, size // 25 + 2))):
                words[at] = f"x{rng.integers(500)}"
            texts[len(texts)] = " ".join(words[: size - int(rng.integers(0, 2))])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram.join(df, "doc_id", "text", n, similarity).collect()}
    assert got == brute_components(texts, n, similarity)


@pytest.mark.parametrize("n, similarity", [(5, 80), (3, 90), (1, 50)])
def test_ngrams_met_by_samples(spark, monkeypatch, n, similarity):
    """As near the bound, with a passage that all long texts share."""
    rng = np.random.default_rng(8)
    monkeypatch.setattr(ngram, "PIECE", 8)
    common = " ".join(f"c{k}" for k in range(20))
    texts = {}
    for size in (1, 4, 5, 11, 12, 33, 60, 150):
        base = [f"w{rng.integers(500)}" for _ in range(size)]
        for _ in range(14):
            words = list(base)
            for at in rng.integers(0, size, rng.integers(0, max(2, size // 20 + 2))):
                words[at] = f"x{rng.integers(500)}"
            texts[len(texts)] = " ".join(words[: size - int(rng.integers(0, 2))] + [common] * (size > 11) + [f"y{rng.integers(9)}"] * (size > 33))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram.join(df, "doc_id", "text", n, similarity, sampled=True).collect()}
    assert got == brute_components(texts, n, similarity)


@pytest.mark.parametrize("sampled", [False, True])
def test_ngrams_shuffle_what_is_too_large_to_broadcast(spark, monkeypatch, odd, sampled):
    monkeypatch.setattr(ngram, "BROADCAST", 0)
    monkeypatch.setattr(ngram, "TEXT", 50)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram.join(odd, "doc_id", "text", 2, 60, sampled=sampled).collect()}
    assert got == brute_components({r.doc_id: r.text for r in odd.collect()}, 2, 60)


def test_cells_of_the_product_are_the_overlaps():
    """Accumulated block by block and cut off by bounds, cells come out as from whole sets; likewise tiles."""
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.choice(rng.integers(0, 2**64, 60, dtype=np.uint64), rng.integers(1, 50))) for _ in range(40)]
    base = np.unique(rng.integers(0, 2**64, 50, dtype=np.uint64))
    rows += [np.sort(np.concatenate([base[k:], rng.integers(0, 2**64, k // 2, dtype=np.uint64)])) for k in range(12)]
    gram, size = np.concatenate(rows), np.array([len(r) for r in rows])
    i, j = np.triu_indices(len(rows), 1)
    for bound in (50, 80, 90, 100):
        want = np.array([100 * len(np.intersect1d(rows[a], rows[b])) >= bound * len(np.union1d(rows[a], rows[b])) for a, b in zip(i, j)])
        assert want.any() == (bound < 100) and np.array_equal(ngram.reach(gram, size, i, j, bound), want)
        assert np.array_equal(ngram._tile(gram, size, bound)[i, j], want)


def test_one_number_with_two_texts(spark):
    rows = [(1, "a b c d"), (1, "p q r s t u"), (2, "a b c d"), (3, "p q r s t u"), (3, "p q r s t u")]
    for sampled in (False, True):
        got = {r.doc_id: r.component_id for r in ngram.join(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", sampled=sampled).collect()}
        assert got == {1: 1, 2: 1, 3: 3}


def test_sampled_ngrams_of_odd_rows(odd, none):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram.join(odd, "doc_id", "text", 5, 80, sampled=True).collect()}
    assert got == brute_components({r.doc_id: r.text for r in odd.collect()}, 5, 80)
    assert ngram.join(none, "doc_id", "text", 5, 80, sampled=True).count() == 0


def test_ngrams_of_odd_rows(odd, none):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram.join(odd, "doc_id", "text").collect()}
    assert got == brute_components({r.doc_id: r.text for r in odd.collect()})
    assert ngram.join(none, "doc_id", "text").count() == 0


def test_without_drops_only_what_is_named(odd, spark):
    gone = spark.createDataFrame([(1,), (5,)], "doc_id long")
    assert sorted(r.doc_id for r in ngram.without(odd, "doc_id", gone).collect()) == sorted(r.doc_id for r in odd.collect() if r.doc_id not in (1, 5))


@pytest.mark.parametrize("small", [0, 2000])
def test_components_of_paths_and_stars(spark, monkeypatch, small):
    monkeypatch.setattr(components, "SMALL", small)
    edges = [(k, k + 1) for k in range(100, 140)] + [(5, k) for k in range(6, 30)] + [(7, 100), (900, 900)]
    got = {r.id: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got.values()) == {5} and set(got) == set(range(100, 141)) | set(range(5, 30))
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 9: files of ids


def test_id_files(spark, tiny):
    lib = Tokenizer.from_file(WORD_BPE)
    start = 0
    got = by([r.asDict() for r in queries.op9_ids(spark, tiny).collect()], "doc_id")
    for d in sorted(table(tiny, "documents"), key=lambda d: d["doc_id"]):
        ids = lib.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        assert got[d["doc_id"]] == {"doc_id": d["doc_id"], "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(ids, "<u4").tobytes())}
        start += len(ids)


def test_id_files_of_odd_rows(odd, none):
    lib = Tokenizer.from_file(WORD_BPE)
    files = idfile.write_ids(odd, "doc_id", "text", WORD_BPE, idfile.folder(odd.sparkSession), 1)
    got = idfile.read_ids(files).orderBy("start").collect()
    want = sorted((r.doc_id, r.text or "") for r in odd.collect())
    assert [r.doc_id for r in got] == [d for d, _ in want] and [r.ids for r in got] == [lib.encode(t, add_special_tokens=False).ids + [1] for _, t in want]
    assert idfile.read_ids(idfile.write_ids(none, "doc_id", "text", WORD_BPE, idfile.folder(odd.sparkSession), 1)).count() == 0


def test_id_files_of_a_long_partition(spark):
    """A partition goes to several files, also where one number's rows do."""
    lib = Tokenizer.from_file(WORD_BPE)
    rows = [(5 if k % 3 else k, f"word {k:03d} of many " * (k % 5)) for k in range(300)]
    files = idfile.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", WORD_BPE, idfile.folder(spark), 1, most=200)
    sizes = [r.n_ids for r in files.collect()]
    assert len(sizes) > 10 and max(sizes) < 500
    got, start = idfile.read_ids(files).orderBy("start").collect(), 0
    for r, (number, text) in zip(got, sorted(rows), strict=True):
        ids = lib.encode(text, add_special_tokens=False).ids + [1]
        assert (r.doc_id, r.start, r.ids) == (number, start, ids)
        start += len(ids)


def test_coder_round_trips_and_finds_damage():
    rng = np.random.default_rng(7)
    for ids in (rng.integers(0, 65536, 5000), np.zeros(3000, np.int64), np.tile(rng.integers(0, 49408, 40), 200), np.arange(10), np.zeros(0, np.int64)):
        lens = np.array([len(ids)])
        image = idfile.pack(np.array([1]), lens, ids)
        assert np.array_equal(idfile.unpack(image)[2], ids)
    image = idfile.pack(np.array([1]), np.array([200_000]), np.arange(200_000) % 77)
    assert len(image) < 100_000
    with pytest.raises(ValueError):
        idfile.unpack(image[:-40] + bytes([image[-40] ^ 255]) + image[-39:])
    with pytest.raises(ValueError):
        idfile.unpack(b"other" + image[5:])
    with pytest.raises(ValueError):
        idfile.pack(np.array([1]), np.array([2]), np.array([5, 65_536]))


def test_order_0_predicts_ids():
    """Ids that no context foresees take fewer bits the more uneven they are spread."""
    rng = np.random.default_rng(14)
    bits = [8 * len(idfile.pack(np.array([1]), np.array([100_000]), (49_000 * rng.random(100_000) ** power).astype(np.int64))) / 100_000 for power in (1, 3, 8)]
    assert bits[0] < 17.2 and bits[1] < bits[0] - 1 and bits[2] < bits[1] - 2, bits


def test_order_0_knows_each_id():
    """Ids scattered over the whole range take little more than their own frequencies tell."""
    rng = np.random.default_rng(15)
    ids = rng.permutation(49_000)[(200 * rng.random(200_000) ** 3).astype(np.int64)]
    share = np.bincount(ids)[np.unique(ids)] / len(ids)
    image = idfile.pack(np.array([1]), np.array([len(ids)]), ids)
    assert np.array_equal(idfile.unpack(image)[2], ids)
    assert 8 * len(image) / len(ids) < -(share * np.log2(share)).sum() + 0.5


def test_blocks_of_many_sizes_and_rare_ids():
    rng = np.random.default_rng(16)
    for n in (1, 63, 64, 65, 1024, 70_001):
        for top in (1, 2, 300, 65_536):
            ids = np.where(rng.random(n) < 0.999, 7, rng.integers(0, top, n))
            assert np.array_equal(idfile.unpack(idfile.pack(np.array([1]), np.array([n]), ids))[2], ids)


def test_ids_of_stretches():
    """Marks, letters, contractions, blanks of all kinds and added tokens have the library's ids, however they meet."""
    lib, own = Tokenizer.from_file(WORD_BPE), idfile.Chunks(WORD_BPE)
    rng = random.Random(17)
    parts = list("abcXYZ'strdvml.,;:!?()\"-_<>|/\\ \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u2003éÈÖßİıſŉĲ×÷ª\u0301\u030c\u0345ǅΣςẞ\u212a한012²½€“–…\x00\x7f\u200b😀")
    parts += ["<|startoftext|>", "<|endoftext|>", "</w>", "'ll", "don't", "Word", "(word", "WORD!", "été,"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(20_000)]
    texts += [f"{a}{chr(k)}{b}" for k in range(33, 0x250) for a in ("", "ab", "(") for b in ("", "cd", "!")]
    ids, lens = own.encode(pa.array([None, *texts], pa.string()))
    ends = np.cumsum(lens)
    assert lens[0] == 0
    for text, n, end in zip(texts, lens[1:], ends[1:]):
        assert ids[end - n : end].tolist() == lib.encode(text, add_special_tokens=False).ids, text


def test_library_is_asked_once_for_a_word_with_marks():
    own = idfile.Chunks(WORD_BPE)
    asked = []
    for name in ("library", "merges"):
        setattr(own, name, SimpleNamespace(encode_batch_fast=lambda strings, _=getattr(own, name), **kw: asked.extend(strings) or _.encode_batch_fast(strings, **kw)))
    own.encode(pa.array(["(élan! Élan*** ÉLAN", "élan, stop", "Stop) (stop***"]))
    words = [w for s in asked for w in s.split()]
    assert sorted(w for w in words if w.isalpha()) == ["stop", "élan"] and len(words) == len(set(words))


# ---- 10: URLs


def brute_url(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    return host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), re.split(r"[?#]", rest[len(host) :])[0]


def test_urls_hosts_paths_and_rules(spark, tiny):
    got = by([r.asDict() for r in queries.op10_urls(spark, tiny).collect()], "page_id")
    for p in table(tiny, "pages"):
        r = got[p["page_id"]]
        host, path = brute_url(p["url"])
        assert (r["host"], r["path"]) == (host, path)
        fit = [(len(h + q), h + q, v) for v, h, q in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(q)]
        assert r["rule"] == (max(fit)[1] if fit else None) and (not fit or r["verdict"] == max(fit)[2])


def test_reputation_blocks_hosts_that_earned_it(spark):
    bad = [(f"http://a.spam.example/{k}", True) for k in range(60)] + [(f"http://b.good.example/{k}", k % 20 == 0) for k in range(200)] + [("http://c.new.example/1", True)]
    outcomes = spark.createDataFrame(bad, "url string, bad boolean")
    urls = ["http://a.spam.example/x", "HTTP://B.GOOD.example?q", "http://c.new.example", None, "no scheme", "://", "http://unknown.example/", "http://x.spam.example:80/"]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id int, url string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in reputation.judge(pages, "url", outcomes, []).collect()}
    assert [got[k].verdict for k in range(8)] == ["block", "allow", "allow", "allow", "allow", "allow", "allow", "allow"]
    assert [(got[k].host, got[k].path) for k in range(8)] == [brute_url(u) for u in urls]
    assert {r.verdict for r in reputation.judge(pages, "url", outcomes.limit(0), []).collect()} == {"allow"} and reputation.judge(pages.limit(0), "url", outcomes, []).count() == 0


def test_the_bound_decides_pages_without_rules(spark):
    """Against the rate of the suffix, not a fixed rate; without labels, or with a lift out of reach, nothing is blocked."""
    rows = [(f"http://h{h}.example.net/{k}", k % 20 == 0) for h in range(10) for k in range(100)] + [(f"http://worse.bad.net/{k}", k % 10 < 3) for k in range(100)]
    outcomes = spark.createDataFrame(rows, "url string, bad boolean")
    pages = spark.createDataFrame([(0, "http://h1.example.net/x"), (1, "http://worse.bad.net/x")], "page_id int, url string")
    verdict = lambda **x: [r.verdict for r in reputation.judge(pages, "url", outcomes, [], **x).orderBy("page_id").collect()]
    assert verdict() == ["allow", "block"] and verdict(lift=20) == ["allow", "allow"]


def test_rates_are_shrunk_towards_the_level_above(spark):
    rows = [("http://a.x.example/", True)] + [("http://b.x.example/", False)] * 300 + [("http://c.y.example/", True)] * 300
    rep = {r.host: r for r in reputation.reputations(spark.createDataFrame(rows, "url string, bad boolean").select(reputation.host_of(F.col("url")).alias("host"), "bad")).collect()}
    assert rep["b.x.example"].rate < rep["a.x.example"].rate < 1 and rep["c.y.example"].bound > 0.9


def test_tokenizer_paths_are_public():
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE_BPE


def test_queries_with_sql_match_it(spark, tiny):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tiny}/{t}.parquet')")
    for name, sql in queries.oracle_sql().items():
        got = queries.queries()[name](spark, tiny)
        want = c.execute(sql)
        names = [d[0] for d in want.description]
        assert sorted(got.columns) == sorted(names)
        assert sorted(map(repr, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(repr, want.fetchall())), name


def test_bands_of_sizes_dont_grow_with_the_batches():
    """A task may cut its texts into any number of batches."""
    import numpy as np

    sizes = np.array([1, 2, 9, 10, 11, 500, 19_998])
    bands = ngram.Bands(90)
    first = bands.of(sizes)
    edges = len(bands.edges)
    for _ in range(1_000):
        again = bands.of(sizes)
    assert len(bands.edges) == edges and all((a == b).all() for a, b in zip(first, again))
    assert (bands.edges[first[0]] <= sizes).all() and (sizes < bands.edges[first[0] + 1]).all()
