"""Resampling, BPE chunks and fill-in-middle against brute force and the libraries."""

import hashlib
import random
import re
from collections import Counter
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from chargelake.llm import chunks, infill, longtext, resample

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = ("doc_id bigint, text string, lang string, row string, n bigint, ids string, tie int, "
          "score double, part int, h1 string, form string")


def table(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "r", 7, "x", 1, 0.5, 2, "h", "f") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = ["Alpha", "beta9", "été", "don't", "x" * 40, "漢字", "<P>", "a,b", "\x00", "ß́"]
    passage = " ".join(rng.choice(words) for _ in range(90))
    out = [(i, " ".join(rng.choice(words[:6] + [f"w{i % 7}"]) for _ in range(rng.randint(0, 70))))
           for i in range(80)]
    out += [(100 + i, f"{i} {passage} {i}" * 3) for i in range(5)]
    out += [(200, None), (201, ""), (202, " \t\n"), (203, "<S>" + passage), (204, "a<|endoftext|>b"),
            (205, "same " * 30), (205, "same " * 30), (206, "same " * 30), (207, "\r\n　. x"),
            (None, "no id " * 12), (None, "no id " * 12), (None, None), (208, "Zz" * 20_000)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows)


# importance resampling

def grams(text, order):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    return words, [b" ".join(words[i:i + k]) for k in range(1, order + 1)
                   for i in range(len(words) - k + 1)]


def brute_importance(rows, target, share, order, buckets, least):
    def counts(texts):
        return Counter(crc32(g) % buckets for t in texts for g in grams(t, order)[1])
    own, wanted = counts(t for _, t in rows), counts(target)
    s, t = sum(own.values()) + buckets, sum(wanted.values()) + buckets
    out = []
    for doc_id, text in rows:
        words, features = grams(text, order)
        gain = [floor(1000 * log((wanted[b] + 1) * float(t and s) / ((own[b] + 1) * float(t))))
                for b in (crc32(g) % buckets for g in features)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(words), len(features), weight,
                    weight + floor(-1000 * log(-log((h + 0.5) / 2**32)))))
    fit = sorted((-r[4], r[0] is None, r[0] or 0, i) for i, r in enumerate(out) if r[1] >= least)
    rank = {i: at + 1 for at, (*_, i) in enumerate(fit[:share[0] * len(fit) // share[1]])}
    return Counter((*r, rank.get(i)) for i, r in enumerate(out))


@pytest.mark.parametrize("order,share,least", [(1, (10, 100), 20), (3, (7, 9), 1), (2, (1, 1), 0)])
def test_importance_is_brute_force(spark, docs, rows, order, share, least):
    target = ["alpha beta9 été", "ALPHA w3, w3", None, ""]
    got = resample.importance(
        docs, table(spark, [(None, t) for t in target]), share, order, 500, least)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == brute_importance(
        rows, target, share, order, 500, least)


def test_drawn_documents_are_whole_rows(spark, docs):
    target = table(spark, [(1, "alpha w3 same no id")])
    for share in ((1, 10), (1, 3), (5, 6), (1, 1), (0, 1)):
        ranks = resample.importance(docs, target, share, least_words=10)
        drawn = resample.resampled(docs, target, share, least_words=10)
        assert drawn.columns == docs.columns
        assert Counter(r["doc_id"] for r in drawn.collect()) == Counter(
            r["doc_id"] for r in ranks.filter("rank is not null").collect())
        assert drawn.exceptAll(docs).count() == 0


def test_importance_of_empty_tables(spark, docs):
    none = table(spark, []).limit(0)
    assert resample.importance(none, docs).count() == 0
    assert resample.resampled(none, docs).count() == 0
    assert resample.importance(docs, none).count() == docs.count()


@given(st.lists(st.binary(max_size=70), max_size=60), st.integers(1, 50))
@settings(deadline=None, max_examples=60)
def test_table_interns_strings(strings, buckets):
    strings = [s for s in strings for _ in range(1 + len(s) % 3)]
    end = np.cumsum([len(s) for s in strings], dtype=np.int64)
    start = end - np.array([len(s) for s in strings], np.int64)
    found = resample.Grams(np.frombuffer(b"".join(strings), np.uint8), start, end)
    assert found.keys().tolist() == [xxhash.xxh64_intdigest(s) for s in strings]
    interned = resample.Table(found, buckets)
    place = {}
    for s, slot in zip(strings, interned.slot.tolist()):
        assert place.setdefault(s, slot) == slot
        assert interned.bucket[slot] == crc32(s) % buckets
    assert len(set(place.values())) == len(place) == len(interned.used)
    assert {s: interned.count[place[s]] for s in place} == Counter(strings)


def test_equal_keys_are_told_apart_by_bytes(monkeypatch):
    # the bytes decide: with one key for all strings nothing changes but the probing
    monkeypatch.setattr(resample.Grams, "keys", lambda self: np.zeros(len(self.start), np.uint64))
    strings = [b"one", b"two", b"one", b"a longer one", b"a longer two", b"two"]
    end = np.cumsum([len(s) for s in strings])
    interned = resample.Table(resample.Grams(np.frombuffer(b"".join(strings), np.uint8),
                                             end - [len(s) for s in strings], end), 10)
    assert len(set(interned.slot.tolist())) == 4 and interned.slot[0] == interned.slot[2]


# chunked byte-pair encoding

def library():
    return chunks._loaded(BYTE_BPE)


def own_ids(encoder, texts):
    ids, ends = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip([0, *ends.tolist()], ends.tolist())]


_BITS = st.sampled_from(["a", "B", "Ünter", "straße ", "×", "÷", "ª", "naïve", "ÿ", "'s", "'", "ll", " ", "  ", "\n", "\t", "\r\n", " ", "　",
                         " ", "é", "слово", "漢字", "，", "7", "٣", "...", "!", "<|endoftext|>",
                         "<|", "endoftext", "|>", "😀", "́", "\x1c", "\x85", "_", " word", " "])


@given(st.lists(st.lists(_BITS, max_size=80).map("".join), max_size=6),
       st.sampled_from([(1, 2, 7), (2, 4, 33), (5, 8, 40), (8, 32, 8192)]))
@settings(deadline=None, max_examples=150)
def test_chunked_ids_are_the_librarys(texts, cut):
    texts = texts + texts[::-1] + ["".join(texts)]
    encoder = chunks.Encoder(library(), chunks.Vocabulary(BYTE_BPE).special, *cut)
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    assert own_ids(encoder, texts) == want
    assert own_ids(encoder, texts) == want      # now from the chunks remembered


def test_shared_passages_are_encoded_once():
    rng = random.Random(2)
    words = [f"{rng.randrange(10**6)}x" for _ in range(3000)]
    passage = " ".join(words[:2000])
    texts = [f"{' '.join(rng.sample(words, 40))} {passage} {' '.join(rng.sample(words, 40))}"
             for _ in range(6)]
    encoder = chunks.Encoder(library(), None)
    assert own_ids(encoder, texts) == [library().encode(t).ids for t in texts]
    assert encoder.reused > 0.8 * 5 * len(passage) / 290
    # a full memory is given up between steps, nothing else changes
    encoder.size = chunks.REMEMBERED_BYTES + 1
    assert own_ids(encoder, texts[:1]) == [library().encode(texts[0]).ids]
    assert encoder.size < chunks.REMEMBERED_BYTES


def test_encoding_and_decoding_tables(spark, docs, rows):
    encoded = chunks.encode(docs, BYTE_BPE)
    decoded = chunks.decode(encoded, BYTE_BPE).select("row.*", "n_tokens", "ids_sha256", "text")
    tokenizer = library()
    want = Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want[(doc_id, len(ids), digest, tokenizer.decode(ids, skip_special_tokens=False))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["text"])
                   for r in decoded.collect()) == want
    assert {r["score"] for r in decoded.collect()} == {0.5}
    assert chunks.decode(chunks.encode(docs.limit(0), BYTE_BPE), BYTE_BPE).count() == 0


def test_broken_characters_decode_as_in_the_library(spark):
    tokenizer = library()
    whole = tokenizer.encode("漢字 é😀").ids
    lists = [whole[i:j] for i in range(len(whole)) for j in range(i, len(whole) + 1)]
    packed = spark.createDataFrame([(np.array(x, "<u4").tobytes(),) for x in lists], "ids binary")
    got = [r["text"] for r in chunks.decode(packed.coalesce(1), BYTE_BPE).collect()]
    assert got == [tokenizer.decode(x, skip_special_tokens=False) for x in lists]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level BPE"):
        chunks.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


# fill in the middle

def brute_infill(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def transformed(docs):
    return docs.transform(infill.fill_in_middle).select(
        "row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output",
        infill.restored(F.col("output"), F.col("form")).alias("text"))


def test_infill_is_brute_force(spark, docs, rows):
    more = [(1000 + i, text) for i in range(40) for text in ("<<S a", "b<P", "M>é<", ">S>")]
    got = Counter(map(tuple, transformed(docs.unionByName(table(spark, more))).collect()))
    assert got == Counter(brute_infill(*r) for r in rows + more)
    assert {f for _, _, f, *_ in got} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(docs).select("row.*").columns == [
        c for c in docs.columns if c != "text"]
    assert transformed(docs.limit(0)).count() == 0


def test_other_layouts_restore(docs):
    layout = infill.Layout("[pre]", "[suf]", "[mid]", 100, 50, "9")
    out = infill.fill_in_middle(docs, layout)
    texts = out.select("row.doc_id", infill.restored(F.col("output"), F.col("form"), layout))
    want = docs.select("doc_id", F.coalesce("text", F.lit("")))
    assert texts.exceptAll(want).count() == want.exceptAll(texts).count() == 0
    assert out.filter("form = 'plain' and n > 0").count() == 0


# long texts

def test_long_texts_in_parts(spark, rows, monkeypatch):
    """Steps of 300 bytes: most texts above go through in many parts, with the same results."""
    for module in (resample, chunks, infill):
        monkeypatch.setattr(module, "LIMIT", 300)
    docs, target = table(spark, rows), table(spark, [(1, "alpha w3 x")])
    tokenizer = library()
    assert Counter(map(tuple, transformed(docs).collect())) == Counter(
        brute_infill(*r) for r in rows)
    assert Counter(map(tuple, resample.importance(docs, target, (1, 2), 3, 500, 5).collect())) == (
        brute_importance(rows, ["alpha w3 x"], (1, 2), 3, 500, 5))
    assert Counter((r["row"]["doc_id"], bytes(r["ids"])) for r in chunks.encode(
        docs, BYTE_BPE).collect()) == Counter(
        (i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes())
        for i, t in rows)


def test_a_text_of_tens_of_megabytes(spark):
    rng = random.Random(4)
    words = [f"{rng.randrange(10**9)}ab" for _ in range(5000)]
    text = " ".join(rng.choice(words) for _ in range(1_000)) + "\n"
    text = text * (24_000_000 // len(text))
    docs = table(spark, [(1, text), (2, "short one")])
    assert Counter(map(tuple, transformed(docs).select(
        "doc_id", "n", F.sha2("output", 256), "text").filter("doc_id = 2").collect()))
    first = transformed(docs).filter("doc_id = 1").select(
        "n", "prefix_chars", "middle_chars", F.sha2("output", 256), F.sha2("text", 256)).first()
    _, n, _, p, m, output, _ = brute_infill(1, text)
    assert tuple(first) == (n, p, m, hashlib.sha256(output.encode()).hexdigest(),
                            hashlib.sha256(text.encode()).hexdigest())
    decoded = chunks.decode(chunks.encode(docs, BYTE_BPE), BYTE_BPE)
    assert decoded.filter("row.doc_id = 1").select(F.sha2("text", 256)).first()[0] == first[4]
    counted = resample.importance(docs, docs).filter("doc_id = 1").first()
    assert counted["n_words"] == text.count(" ") + text.count("\n")


def test_cuts_cover_a_text():
    data = np.frombuffer(b"abc def ghij" * 50_000, np.uint8)
    borders = longtext.cuts(data, 1000, resample._between_words)
    assert borders[0] == 0 and borders[-1] == len(data) and borders == sorted(set(borders))
    assert all(data[at] == 0x20 for at in borders[1:-1]) and max(np.diff(borders)) < 1010
    assert longtext.cuts(data[:3], 1, resample._between_words) == [0, 3]
    assert longtext.cuts(data[:0], 1, resample._between_words) == [0, 0]
