"""The pipeline on the smallest tables and on odd rows."""

from collections import Counter

from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import pii, quality
from millrace.llm.queries import BYTE_BPE
from tests.llm.test_operators import WORD, brute_components, brute_pii, level, table


def test_stages_against_brute_force(spark, tiny):
    """Every stage on what the one before kept, against a plain computation on the same rows."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "pii", "mix", "tokens"]
    frames = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frames[-1], tiny)
        assert k == 4 or out.columns == docs.columns
        frames.append(spark.createDataFrame(out.toPandas(), out.schema))
    everything, accepted, alone, clean, mixed, tokens = ([r.asDict() for r in f.collect()] for f in frames)

    # quality: the classifier's own scores decide; most good texts stay, most bad ones go
    labels = {r["doc_id"]: r["quality"] for r in table(tiny, "labels")}
    scores = {r.doc_id: r.score for r in quality.scored(docs, quality.train(docs, quality.learnable(spark.read.parquet(f"{tiny}/labels.parquet")), "doc_id", "text")).collect()}
    kept = {r["doc_id"] for r in accepted}
    assert kept == {i for i, s in scores.items() if s >= corpus_pipeline.ACCEPT}
    good, bad = ([i for i, q in labels.items() if q == want and i in scores] for want in (1, 0))
    assert sum(i in kept for i in good) >= 0.95 * len(good) and sum(i in kept for i in bad) <= 0.5 * len(bad)

    # near copies: the smallest of each group by all pairs
    groups = brute_components({r["doc_id"]: r["text"] for r in accepted}, 5, 80)
    assert {r["doc_id"] for r in alone} == {i for i, (_, root) in groups.items() if i == root}

    # personal data: nothing that the plain patterns find is left, and texts without any are as they were
    before = {r["doc_id"]: r["text"] for r in alone}
    assert set(before) == {r["doc_id"] for r in clean}
    for r in clean:
        assert not brute_pii(r["text"] or "") and (r["text"] == before[r["doc_id"]]) == (not pii.scan(before[r["doc_id"]] or "")) and r["n_chars"] == len(r["text"])

    # mix: rows of what was clean, as often as the mix says, near the targets
    copies = Counter(r["doc_id"] for r in mixed)
    texts = {r["doc_id"]: r for r in clean}
    assert all(r == texts[r["doc_id"]] for r in mixed) and max(copies.values()) <= 3
    size = {i: len(WORD.findall(r["text"] or "")) for i, r in texts.items()}
    totals, taken = Counter(), Counter()
    for i, r in texts.items():
        totals[r["source"]] += size[i]
        taken[r["source"]] += size[i] * copies[i]
    for source, target in level(totals, [1, 2, 3], 3).items():
        # whole documents of a source with a few can't come nearer than half of its longest
        assert abs(taken[source] - target) <= max(0.05 * target, max(size[i] for i, r in texts.items() if r["source"] == source) / 2) + 1

    # tokens: the library's
    library = Tokenizer.from_file(BYTE_BPE)
    want = sorted((r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids) for r in mixed)
    assert sorted((r["doc_id"], r["ids"]) for r in tokens) == want and all(r["exact"] and r["n_tokens"] == len(r["ids"]) for r in tokens)


def test_columns_of_any_name_pass_through(spark, tiny):
    rows = [(k, f"{k} words of a plain text that is long enough to be kept by all means, a@b.co", "s", "clash") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, score string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tiny)
        assert out.columns == docs.columns and {r.score for r in out.collect()} <= {"clash"}


def test_pipeline_of_odd_rows(spark, odd, none, tiny):
    for docs in (odd, none):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, tiny)
            numbers = {r.doc_id for r in out.select("doc_id").collect()}
            assert numbers <= {r.doc_id for r in docs.select("doc_id").collect()} and out.count() <= (3 if k == 3 else 1) * docs.count()
            assert out.columns == docs.columns if k < 4 else out.columns == ["doc_id", "source", "n_tokens", "ids", "exact"]
    near = corpus_pipeline.drop_near_copies(spark, odd, tiny)
    # 1, 6 (twice) and 10 hold the same four words, 8 and 9 the same two
    assert sorted(r.doc_id for r in near.collect()) == [1, 2, 3, 4, 5, 7, 8]


def test_near_copies_are_five_words_at_80(spark, tiny):
    """15 words appended to 100 leave 96 of 111 five-word shingles, and less than 90 % of the three-word ones."""
    words = [f"w{k}" for k in range(115)]
    rows = [(1, " ".join(words[:100])), (2, " ".join(words)), (3, " ".join(words[60:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, tiny).collect()) == [1, 3]
