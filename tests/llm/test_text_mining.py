"""Collocations, fill-in-the-middle and licence notices against brute-force versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cinepulse.llm import collocations, license_index, middle_fill
from cinepulse.llm.license_texts import BASE_PHRASES, TEMPLATES
from cinepulse.llm.queries import OPERATORS

SF = "/root/testdata/sf0.001"
LICENSE = "Released under the MIT License. All rights reserved; ALL RIGHTS\nreserved. Licensed under CC BY-NC 4.0"
EDGE = [
    (1, "en", None),
    (2, "en", ""),
    (3, None, "to be or not to be, to be. To BE!"),
    (3, None, "to be or not to be, to be. To BE!"),
    (4, "und", "to be\tor  not\x0bto be"),
    (5, "de", " \n\t ,,; "),
    (6, "fr", "é𝄞 ß x\r\n  y  É <P"),
    (7, "en", "lorem ipsum dolor sit amet " * 4000 + "x" * 70_000 + " . " + "a b c d " * 9000),
    (None, "", "no id <S> at all"),
    (8, "en", LICENSE),
]


@pytest.fixture(scope="module")
def edge(spark):
    """Edge cases with further columns whose names clash with the operators' own."""
    rows = [(i, la, t, 1.5, "x", "y", 7, [1]) for i, la, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string, score double, form string, fim string, n int, notices array<int>").cache()


# --- collocations ------------------------------------------------------------------


def _phrases(rows, longest):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    return counts, sizes


def _collocations(rows, min_count, longest=4, percent=80, top=2000):
    counts, sizes = _phrases(rows, longest)
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= min_count}
    swallowed = set()
    for (lang, *words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if 100 * a >= percent * counts[(lang, *words[i : i + k])]:
                    swallowed.add((lang, *words[i : i + k]))
    out = []
    for (lang, *words), a in candidates.items():
        if (lang, *words) not in swallowed:
            cuts = [(counts[(lang, *words[:k])], counts[(lang, *words[k:])], k) for k in range(1, len(words))]
            score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for x, y, k in cuts)
            out.append((lang, " ".join(words), a, left, right, sizes[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(r[0], i + 1, *r[1:]) for i, r in enumerate(mine[:top])]
    return sorted(ranked)


def _mined(spark, df, **parameters):
    return sorted(tuple(r) for r in collocations.mine(spark, df, **parameters).collect())


def test_collocations_of_edge_cases(spark, edge):
    want = _collocations([(la, t) for _, la, t in EDGE], 2)
    assert {r[0] for r in want} >= {"und", "en"}
    assert _mined(spark, edge, min_count=2) == want
    assert _mined(spark, edge.limit(0)) == []
    assert _mined(spark, edge, min_count=2, longest=2, top=3) == _collocations([(la, t) for _, la, t in EDGE], 2, longest=2, top=3)


@pytest.mark.parametrize("percent", [80, 100])
def test_collocations_of_random_texts(spark, percent):
    """A vocabulary shared by two languages, a hot pair, ties, texts cut into many blocks."""
    rng = random.Random(5)
    words = ["a", "b", "c", "dd", "É", "x1"]
    rows = [(rng.choice(["en", "fr", None]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", "\n"]) for _ in range(rng.randrange(400)))) for _ in range(60)]
    df = spark.createDataFrame([(la, t + " hot pair" * 40) for la, t in rows], "lang string, text string").repartition(4)
    want = _collocations([(r.lang, r.text) for r in df.collect()], 30, percent=percent)
    assert want and _mined(spark, df, subsumed_percent=percent) == want


def _unroll(counter, got):
    for batch in counter.stripes():
        for r in batch.to_pylist():
            for w, n in zip(r["next"], r["n"]):
                got[(r["size"], r["prefix"], w)] += n


def test_blocks_do_not_change_stripes(spark):
    text = ("to be, or not to be  that is " * 50 + "\n" + "word " * 90 + " \t " * 300 + "end. ") * 3
    want, sizes = _phrases([("en", text)], 4)
    full = np.full(collocations.FILTER_BITS // 64, 2**64 - 1, np.uint64)
    for block, every in ((16, 1), (100, 7), (1 << 20, 1)):
        got, counter = Counter(), collocations.StripeCounter(full, np.zeros(0, np.uint64), 4)
        for i, (words, langs) in enumerate(collocations._blocks(["en"], [text.encode()], 4, block)):
            counter.hot = np.sort(words.hashes[:2])
            counter.add(words, langs)
            if i % every == 0:
                counter.reduce()
            if i % (3 * every) == 0:
                _unroll(counter, got)
        _unroll(counter, got)
        assert got[(0, "", "")] == sizes["en"]
        for (_, *p), n in want.items():
            assert got[(len(p) - 1, " ".join(p[:-1]), p[-1]) if len(p) > 1 else (1, p[0], "")] == n
        assert len(got) == len(want) + 1


def test_stripes_merge_over_batches():
    rng = random.Random(2)
    rows = sorted(
        (lang, len(prefix.split()), prefix, seg, [rng.choice("abc") for _ in range(rng.randrange(4))])
        for lang in ("en", "fr") for prefix in ("", "x", "x y") for seg in (0, 1) for _ in range(5)
    )
    rows = [(*r[:4], r[4], [rng.randrange(1, 9) for _ in r[4]]) for r in rows]
    want = Counter()
    for lang, size, prefix, seg, words, ns in rows:
        for w, n in zip(words, ns):
            want[(lang, size, prefix, seg, w)] += n
    want = sorted((*k[:3], k[4], n) for k, n in want.items() if n >= 9 or k[1] == 0)
    names = collocations._STRIPE_TYPES.names
    for step in (1, 3, 7, 100):
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[a : a + step]], collocations._STRIPE_TYPES) for a in range(0, len(rows), step)]
        got = sorted(tuple(r.values()) for b in collocations._merge(iter(batches), 9) for r in b.to_pylist())
        assert got == want


# --- fill in the middle ---------------------------------------------------------------


def _middle(doc_id, text, cut):
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    text = text or ""
    starts = cut(text)
    a, b = sorted((starts[h1 % len(starts)], starts[h2 % len(starts)]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return "plain", len(starts) - 1, None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return "spm", len(starts) - 1, a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return "psm", len(starts) - 1, a, b - a, f"<P>{p}<S>{s}<M>{m}"


CUTS = {
    "char": lambda t: range(len(t) + 1),
    "word": lambda t: [m.start() for m in re.finditer("[^ \t-\r]+", t)] + [len(t)],
    "line": lambda t: [0] + [m.end() for m in re.finditer("\n", t)],
}


@pytest.mark.parametrize("unit", sorted(CUTS))
def test_middles(edge, unit):
    rng = random.Random(unit)
    more = [(100 + i, "en", "".join(rng.choice("ab é𝄞\n\t<PSM>") for _ in range(rng.randrange(300)))) for i in range(200)]
    df = edge.sparkSession.createDataFrame(more, "doc_id long, lang string, text string").unionByName(edge.select("doc_id", "lang", "text"))
    got = middle_fill.transform(df, unit=unit).withColumn("back", middle_fill.restored()).collect()
    assert len(got) == len(more) + len(EDGE)
    for r in got:
        assert (r.form, r.n, r.prefix_chars, r.middle_chars, r.fim) == _middle(r.doc_id, r.text, CUTS[unit]), r.doc_id
        assert r.back == (r.text or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("unit", sorted(CUTS))
def test_cuts_of_blocks_of_every_size(unit):
    """The last text's cut lies at the end of the block while other texts are still searched."""
    rng = random.Random(unit)
    for size in range(1, 260):
        text = "".join(rng.choice("ab\n ") for _ in range(size))
        for texts in ([text, ""], [text, "", ""], [text[:-1], text[-1]]):
            h1, h2 = (np.array([rng.randrange(1 << 32) for _ in texts[1:]] + [(1 << 32) - 1]) for _ in range(2))
            h2[-1] = len(CUTS[unit](texts[-1])) - 1  # behind the last unit
            got = middle_fill.cut_texts([t.encode() for t in texts], h1, h2, unit)[3]
            starts = [CUTS[unit](t) for t in texts]
            assert got.tolist() == [sorted((s[a % len(s)], s[b % len(s)])) for s, a, b in zip(starts, h1, h2)], (size, texts)


def test_middles_of_a_block_that_fills_its_cells(spark):
    rows = [(1, "x" * 40 + " é " + "y" * 19), (2, None)]
    got = middle_fill.transform(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).orderBy("doc_id").collect()
    assert sum(len((t or "").encode()) for _, t in rows) == 63
    assert [(r.form, r.n, r.prefix_chars, r.middle_chars, r.fim) for r in got] == [_middle(i, t, CUTS["char"]) for i, t in rows]


def test_middles_replace_clashing_columns(edge):
    done = middle_fill.transform(edge)
    assert sorted(done.columns) == sorted(edge.columns + ["prefix_chars", "middle_chars"])
    assert done.count() == len(EDGE) and done.filter("n is null").count() == 0
    assert middle_fill.transform(edge.limit(0)).count() == 0


def test_wavelet_ranks():
    rng = np.random.default_rng(3)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 5, size).astype(np.uint8)
        matrix = middle_fill.WaveletMatrix(symbols)
        at = np.arange(size + 1)
        for s in range(5):
            assert (matrix.rank(s, at) == np.concatenate([[0], np.cumsum(symbols == s)])).all()


# --- licences ----------------------------------------------------------------------------


def _words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _base(text):
    words = _words(text)
    return sorted((i, label) for p, label in BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())


def test_base_phrases(spark, edge):
    rng = random.Random(9)
    pool = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "é", "x"]
    texts = [t for *_, t in EDGE] + ["".join(rng.choice(pool) + rng.choice([" ", "-", "\n", "  ", "."]) for _ in range(rng.randrange(80))) for _ in range(200)]
    texts.append("cc by " * 120_000)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in license_index.with_licenses(df).collect():
        assert r.n_words == len(_words(r.text))
        assert [(p.word, p.label) for p in r.base_places] == _base(r.text)
        assert 0 <= r.license_score <= 1 and (r.license_score == 1 or not r.base_places)
    done = license_index.with_licenses(edge)
    assert sorted(done.columns) == sorted({*edge.columns, "n_words", "base_places", "notices", "license_score"})
    assert done.count() == len(EDGE) and license_index.with_licenses(edge.limit(0)).count() == 0


def _notices(text):
    """Accepted notices by looking at every start of every template."""
    index, words = license_index.LicenseIndex(), _words(text)
    slack, out = license_index.SLACK, []
    for t in TEMPLATES:
        mine = _words(t.text)
        weight = {w: index.rarity[index.number[w.encode()]] for w in mine}
        rare = sorted(dict.fromkeys(mine), key=lambda w: -weight[w])[: license_index.ANCHORS]
        for s in range(-slack, len(words) + slack):
            near = lambda j: words[max(0, s + j - slack) : max(0, s + j + slack + 1)]
            score = sum(weight[w] for j, w in enumerate(mine) if w in near(j)) / sum(weight[w] for w in mine)
            window = words[max(0, s - slack) : s + len(mine) + slack]
            has = lambda p: any(window[i : i + len(p.split())] == p.split() for i in range(len(window)))
            if score >= license_index.LEAST_SCORE and all(has(p) for p in t.phrases) and all(w in near(mine.index(w)) for w in rare):
                out.append((t.label, s))
    return out


def test_notices_equal_every_start(spark):
    rng = random.Random(4)
    for t in TEMPLATES:
        words = _words(t.text)
        for texts in (t.text, "# Some words first\n * " + t.text.replace(" ", "\n * ") + " more", " ".join(words[:4] + ["inserted"] + words[4:]), " ".join(w for w in words if rng.random() < 0.9)):
            found = {(b, s) for b, s, _ in license_index.LicenseIndex().scan(texts.encode())[2]}
            brute = _notices(texts)
            assert {b for b, _ in found} == {b for b, _ in brute}, (t.label, texts)
            assert all(any(b == c and abs(s - u) <= license_index.SLACK for c, u in brute) for b, s in found)
        assert t.label in {b for b, *_ in license_index.LicenseIndex().scan(t.text.encode())[2]}


def test_plain_prose_has_no_notice():
    prose = "The general idea of a public license is that rights are granted; the mit students use the software, by version 2 of the book, free of charge. " * 30
    assert license_index.LicenseIndex().scan(prose.encode())[1:3] == ([], [])


# --- registered queries ---------------------------------------------------------------------


def test_license_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in OPERATORS["op13_license_index"](spark, SF).collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        base, r = _base(text), got[i]
        places = [w for w, _ in base]
        assert (r.n_words, r.n_base) == (len(_words(text)), len(base))
        assert (r.first_word, r.last_word) == (min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted({b for _, b in base}))
        assert set(filter(None, r.labels.split(","))) >= {b for _, b in base}
        assert ("mit" in r.labels.split(",")) == ("under the mit license" in text.lower())
    assert any(r.labels for r in got.values())


def test_middle_query_restores_every_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = OPERATORS["op12_wavelet_middle"](spark, SF)
    same = got.join(docs, "doc_id").filter(F.col("restored_sha256") == F.sha2(F.coalesce("text", F.lit("")), 256))
    assert same.count() == docs.count()


# --- earlier operators: clashing names, long white space, number characters ------------------


def test_columns_of_equal_names_are_replaced(spark):
    from cinepulse.llm import language, pii, quality, sentencepiece_codec

    rows = [(1, "mail a@b.co or call", 1, 2.5, "x", [3], "y", b"z"), (2, None, 1, 2.5, "x", [3], "y", b"z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, Score double, lang_pred string, base_spans array<int>, parity string, decoded binary")
    found = pii.with_spans(spark, df, pii.fit())
    assert found.columns == [*df.columns, "all_spans"] and [len(r.base_spans) for r in found.orderBy("doc_id").collect()] == [1, 0]
    coded = sentencepiece_codec.encoded(df).orderBy("doc_id").collect()
    assert [(r.decoded, r.parity) for r in coded] == [("mail a@b.co or call", True), ("", True)]
    sample = [(["good words of sense here"], 1), (["zzz qqq zzz qqq"], 0)]
    model = quality.train([t[0] for t, _ in sample] * 5, [y for _, y in sample] * 5)
    scored = quality.with_score(spark, df, model)
    assert len(scored.columns) == len(df.columns) and all(0 <= r.score <= 1 for r in scored.collect())
    named = language.with_language(spark, df, language.train({"en": ["the words of"], "de": ["die und der"]}, language.read_pieces(language.default_vocabulary())))
    assert sorted(c.lower() for c in named.columns) == sorted(c.lower() for c in df.columns)
    assert [r.lang_pred in ("en", "de", "und") for r in named.collect()] == [True, True]


def test_number_characters_are_no_letters():
    from cinepulse.llm import language

    assert [language.WORD.findall(t) for t in ("½ ² Ⅷ ④", "a½b", "x² 一 é")] == [[], ["a", "b"], ["x", "一", "é"]]


@pytest.mark.parametrize("run", [" ", "\n", "\t", " \n\t ", "  ", "\x1c "])
def test_long_white_space_has_the_library_ids(run):
    from tokenizers import Tokenizer

    from cinepulse.llm import tokens

    path = tokens.default_vocabulary()
    library, own = Tokenizer.from_file(path), tokens.TextEncoder(path)
    for n in (999, 1000, 1001, 2_000_000 if run in " \n" else 50_000):
        blank = run * (n // len(run))
        for text in (blank, f"a{blank}b", f"x y{blank}'s {blank}<|endoftext|>{blank}5"):
            assert np.frombuffer(own.encode([text])[0], np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids
