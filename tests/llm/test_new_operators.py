"""Token counts, phrases and source divergences against brute force, and their edge cases."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from kgspark.llm import op11_token_counts as op11
from kgspark.llm import op12_phrases as op12
from kgspark.llm import op13_divergence as op13
from kgspark.llm import sketch

DOCS = "doc_id bigint, text string, lang string, source string"
ALPHABET = " \n\t ab th ing é漢字ｆﬁ▁<s></s>\x07😀é0123....=== aaaa"


def noise(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken"])
@pytest.mark.parametrize("unit", [1, 7, 64])
def test_cut_texts_have_the_tokens_of_whole_ones(name, unit):
    rng, counter = random.Random(unit), op11.load(name)
    texts = [noise(rng, rng.randrange(300)) for _ in range(150)] + ["", " ", "a" * 2000, "the of " * 300, "漢" * 500]
    assert list(counter.counts(iter(texts), 500, unit)) == counter.lengths(texts)


def test_token_counts_of_rows(spark, pieces):
    rng = random.Random(2)
    texts = [None, "", " ", "<s> a </s>", "x", "x", noise(rng, 200_000), "word " * 60_000, *[noise(rng, rng.randrange(9000)) for _ in range(40)]]
    rows = [(i % 45, t, "a", "b") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string, n_tokens string").repartition(3)
    out = op11.with_token_counts(docs, "piece_bpe_32k.model", 4096)
    assert out.columns == ["doc_id", "text", "row", "n_bytes", "n_tokens", "over_limit"]
    got = sorted((r["doc_id"], r["text"] or "", r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out.collect())
    n = [len(pieces.encode(t or "")) for t in texts]
    assert got == sorted((i % 45, t or "", len((t or "").encode()), k, k > 4096) for i, (t, k) in enumerate(zip(texts, n)))
    assert op11.with_token_counts(docs.limit(0), "piece_bpe_32k.model", 4).count() == 0


def test_token_counts_query(spark, pieces, tmp_path):
    rows = [(1, None), (2, "One two"), (2, "One two"), (None, "three " * 5000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = op11.query(spark, str(tmp_path))
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    two, three = len(pieces.encode("One two")), len(pieces.encode("three " * 5000))
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 0, 0, False), (2, 7, two, False), (2, 7, two, False), (None, 30000, three, True)], key=str)


def test_a_stretch_without_a_cut_stays_whole():
    counter = op11.Counter(lambda texts: texts, lambda text, at: text[at] == "|")
    assert list(counter.units("a" * 50 + "|" + "b" * 50, 10)) == ["a" * 50, "|" + "b" * 50]
    assert list(counter.units("", 10)) == [""]


def corpus(seed=3):
    """Documents of three languages and uneven sources, with nulls, ties, repeats and one very long text."""
    rng = random.Random(seed)
    zipf = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(4000)]
    rows = []
    for i in range(120):
        n = rng.randrange(0, 60)
        text = rng.choice(zipf).upper() + rng.choice(["", "é", "漢"]) + " "
        text += "".join(rng.choice(zipf) + rng.choice([" ", " ", " ", "\t", ". ", "\n", ", ", "  ", "\x0b", "-", "\x00 "]) for _ in range(n))
        rows.append((i if i % 9 else None, text, rng.choice(["en", "en", "fr", None]), rng.choice(["hot", "hot", "a", "b", None, ""])))
    rows += [rows[5]] * 3
    rows += [(1, None, "en", "a"), (2, "", "en", "quiet"), (3, " .\n", "fr", "a"), (4, None, "solo", "only"), (5, "one two three", "solo", "only"), (6, "x", None, None)]
    rows.append((7, "".join(rng.choice(zipf) + rng.choice([" ", ". "]) for _ in range(6000)), "en", "a"))
    rows.append((8, "tail " * 3000, "fr", "b"))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).withColumns({"term": F.lit(1), "n": F.lit("x"), "value": F.lit("y")}).repartition(5)


def low(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def mined(rows, least, longest, top):
    f, n = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    frequent = {p: a for p, a in f.items() if a >= least}
    out = []
    for (lang, p), a in frequent.items():
        if len(p) < 2:
            continue
        if any(g == lang and len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for (g, q), b in frequent.items()):
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, l, r, n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        best = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, i + 1, *x[1:]) for i, x in enumerate(best[:top])]
    return sorted(ranked)


@pytest.mark.parametrize(("least", "longest", "top", "block"), [(4, 5, 2000, 1 << 20), (3, 4, 25, 900), (2, 2, 10, 1)])
def test_phrases(spark, docs, least, longest, top, block):
    got = op12.phrases(docs, op12.Mining(least, longest, top, block))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = mined(corpus(), least, longest, top)
    assert len(want) > 15 and sorted(map(tuple, got.collect())) == want


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    monkeypatch.setattr(op12.tx, "CHUNK", 64)
    for text in ("a b c. " * 100, "a b " * 100 + ". d e", "a b c" * 60, "x. " + "a b " * 50 + "! " + "c d " * 50):
        buf = np.frombuffer(text.encode(), np.uint8)
        parts = list(op12._cut(buf, np.array([0, len(buf)])))
        assert b"".join(p.tobytes() for p, _ in parts) == text.encode()
        assert all(p.tobytes().decode()[-1] in ".!" for p, _ in parts[:-1])


def test_exact_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**13, 10**14, [2 * 10**13, 10**13], [10**13 + 7, 10**13])], "f bigint, n bigint, first array<bigint>, last array<bigint>")
    got = row.select(op12._best_cut(2).alias("c")).first()["c"]
    assert (got["score"], got["l"], got["r"]) == (1000 * 10**27 // (2 * 10**13 * (10**13 + 7)), 2 * 10**13, 10**13 + 7)


def diverged(rows, least, top):
    df, n, own, groups = Counter(), Counter(), Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low(text))
        df.update((lang, t) for t in set(terms))
        n.update((lang, t) for t in terms)
        own.update((lang, source, t) for t in terms)
    kept = {lang: [t for g, t in df if g == lang and df[g, t] >= least] for lang in {g for g, _ in groups}}
    rate = lambda count, total, v: 1 + 10**9 * (count + 1) // (total + v)
    p, q = {}, {}
    for lang, terms in kept.items():
        total = sum(n[lang, t] for t in terms)
        q.update({(lang, t): rate(n[lang, t], total, len(terms)) for t in terms})
    for lang, source in groups:
        total = sum(own[lang, source, t] for t in kept[lang])
        p.update({(lang, source, t): rate(own[lang, source, t], total, len(kept[lang])) for t in kept[lang]})
    far = lambda a, b: (a - b) * (a - b) // b
    out = []
    for lang, source in groups:
        pair = [(-sum(far(p[lang, source, t], p[lang, other, t]) for t in kept[lang]), other.encode()) for g, other in groups if g == lang and other != source]
        term = [(-far(p[lang, source, t], q[lang, t]), t.encode()) for t in kept[lang] if own[lang, source, t] and p[lang, source, t] > q[lang, t]]
        for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
            out += [(lang, source, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(items)]
    return sorted(out)


@pytest.mark.parametrize(("least", "top"), [(3, 200), (1, 5), (20, 3)])
def test_divergences(spark, docs, least, top):
    got = op13.divergences(docs, op13.Audit(min_docs=least, top=top))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    want = diverged(corpus(), least, top)
    assert len(want) > 40 and sorted(map(tuple, got.collect())) == want


def test_a_crowded_sketch_never_underestimates_and_changes_nothing(spark, docs):
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "text")])
    df = Counter()
    for _, text, lang, _ in corpus():
        df.update((lang or "", t) for t in set(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low(text))))
    for width in (8, 64, 1024):
        table = op13.document_sketch(rows, width, 200)
        keys = list(df)
        data = [t.encode() for _, t in keys]
        off = np.concatenate(([0], np.cumsum([len(t) for t in data])))
        h = op13.tx.words(np.frombuffer(b"".join(data), np.uint8), off, op13._GAP).hash
        h = op13.tx.mix(h + np.array([op13._seed(lang) for lang, _ in keys], np.uint64))
        told = np.min([table[r, sketch.cells(h, r, width)] for r in range(len(table))], axis=0)
        assert (told >= np.minimum([df[k] for k in keys], 200)).all()
    few = op13.divergences(docs, op13.Audit(most_cells=8))
    assert sorted(map(tuple, few.collect())) == diverged(corpus(), 3, 200)
    few = op12.phrases(docs, op12.Mining(4, most_cells=8))
    assert sorted(map(tuple, few.collect())) == mined(corpus(), 4, 5, 2000)


def test_phrases_and_divergences_without_rows(spark, docs, tmp_path):
    assert op12.phrases(docs.limit(0)).count() == 0 and op13.divergences(docs.limit(0)).count() == 0
    bare = spark.createDataFrame([(1, None, "en", "a"), (2, "", "en", "b"), (3, "x", "fr", "a")], DOCS)
    assert op12.phrases(bare).count() == 0
    assert sorted(map(tuple, op13.divergences(bare).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_the_queries_of_phrases_and_divergences(spark, tmp_path):
    rows = [(i, "alpha beta gamma. the end", ["en", None][i % 2], ["a", "b", None][i % 3]) for i in range(230)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = op12.query(spark, str(tmp_path))
    assert dict(got.dtypes)["rank"] == "bigint" and sorted(map(tuple, got.collect())) == mined(rows, 100, 5, 2000)
    got = op13.query(spark, str(tmp_path))
    assert dict(got.dtypes)["rank"] == "int" and sorted(map(tuple, got.collect())) == diverged(rows, 3, 200)


def test_files_of_large_rows_are_short(spark):
    """Parquet holds as many rows at once as a file has, so large rows get files of few."""
    from kgspark.llm.shared import materialize

    table = materialize(spark.range(0, 20, 1, 2), rows_a_file=4)
    assert len(table.inputFiles()) == 6 and sorted(r["id"] for r in table.collect()) == list(range(20))
    assert len(materialize(spark.range(0, 20, 1, 2)).inputFiles()) == 2


def test_blocks_send_their_phrases_in_buckets(spark):
    """What moves of the lengths of phrases is a row for each block and bucket, not one for each list; sums and ids are those of all blocks."""
    blocks = [(b, [7, 7, 9], [8, 9, 1], [60, 30, 50 + b]) for b in (0, 1, 2)]
    lists = spark.createDataFrame(blocks, "block bigint, prefix array<bigint>, suffix array<bigint>, n array<bigint>").withColumn("lists", F.lit(b""))
    told, _ = op12._frequent(lists, ["prefix", "suffix"], op12.Mining(min_count=100), 1000)
    rows = told.collect()
    phrases = {(r.prefix, r.suffix): (r.id, r.f) for r in rows if r.block is None}
    assert phrases == {(7, 8): (0, 180), (9, 1): (1, 153)}
    sent = lists.select("block", "n", "prefix", "suffix").mapInArrow(op12._sent(["prefix", "suffix"], spark.sparkContext.broadcast(np.full((1, 1 << 16), 100, np.uint8)), 100, 1), op12._SENT)
    assert sent.count() == 3
    got = {}
    for r in rows:
        if r.block is not None:
            for at, id_ in zip(np.cumsum(op12._unpack(bytes(r.list), np.int64)), op12._unpack(bytes(r.ids), np.int64)):
                got[r.block, int(at)] = int(id_)
    assert len(got) == 6 and set(got.values()) == {0, 1}
