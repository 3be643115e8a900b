"""The training-data operators against brute force, and on awkward rows."""

import hashlib
import os
import random
import re
from collections import Counter
from math import log2

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from chargelake.llm import (
    itq, merkle, mixing, packing, ppm, qda, simhash, substring, units, urllists, warc)

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id string, "
          "key int, row string, rest string, score double")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = [a + b for a in ("th", "er", "on", "ti", "Éa") for b in ("in", "ou", "re", "s.", "!")]
    passage = [rng.choice(words) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 150))), "en", f"s{i % 4}")
            for i in range(60)]
    rows += [(100 + i, " ".join(passage[i:] + [str(i)] * 3), "en", "s0") for i in range(8)]
    rows += [(200 + i, rows[3][1], "en", "s1") for i in range(4)]       # copies
    rows += [(300, None, None, None), (301, "", "en", None), (302, " \t\n ", None, "s2"),
             (303, "a " * 80, "en", "s2"), (304, "123 456", "en", "s2"),
             (305, "tie", "en", "s2"), (305, "tie", "en", "s2"),         # repeated row
             (306, "one", "en", "s2"), (306, "other", "en", "s2"),       # repeated id
             (None, "no id here", "en", "s3"), (None, None, None, "s3"),
             (307, "word " * 30_000, "en", "s3")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(
        [(i, t, l, s, len(t or ""), "x", 1, "r", "q", 0.5) for i, t, l, s in texts], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return (text or "").encode().split()


def test_substring_removal_is_exact(docs, texts):
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in
                  substring.remove_repeats(docs).select(
                      "row.doc_id", "n_words", "n_removed", "kept").collect())
    seen = Counter(tuple(w[i:i + 35]) for w in (split(t[1]) for t in texts)
                   for i in range(len(w) - 34))
    want = Counter()
    for doc_id, text, *_ in texts:
        w = split(text)
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i:i + 35])] > 1:
                gone[i:i + 35] = [True] * 35
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        want[(doc_id, len(w), sum(gone), kept)] += 1
    assert got == want


def test_crowded_anchors_count_windows(docs, monkeypatch):
    usual = sorted(substring.remove_repeats(docs).select("kept").collect())
    monkeypatch.setattr(substring, "KINDS", 1)
    assert sorted(substring.remove_repeats(docs).select("kept").collect()) == usual


def test_long_blocks_crowd_an_anchor(spark, monkeypatch):
    # one line repeated: a block is as long as its document
    line = "the same line again and again and once more ".split()
    texts = [line * n + [f"end{n}"] for n in (400, 500, 600)] + [["x", "y"] * 10]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)],
                                 "doc_id bigint, text string")
    seen = Counter(tuple(w[i:i + 35]) for w in texts for i in range(len(w) - 34))
    want = []
    for w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i:i + 35])] > 1:
                gone[i:i + 35] = [True] * 35
        want.append(" ".join(x for x, g in zip(w, gone) if not g))
    compared, real = [], substring._same_anchor

    def spied(kinds, threshold):
        compared.append({r["anchor"]: r["n"] for r in substring._sized(kinds).filter(
            "not crowded").groupBy("anchor").agg(
            F.sum(F.size("windows")).alias("n")).collect()})
        compared.append(substring._sized(kinds).filter("crowded").count())
        return real(kinds, threshold)

    monkeypatch.setattr(substring, "_same_anchor", spied)
    for limit in (1_000, 1_000_000):
        monkeypatch.setattr(substring, "WINDOWS", limit)
        got = substring.remove_repeats(docs).select("row.doc_id", "kept").collect()
        assert [k for _, k in sorted(got)] == want
    assert max(compared[0].values(), default=0) <= 1_000 < max(compared[2].values())
    assert compared[1] == 3 and compared[3] == 0


def brute_print(text):
    words = [w.lower() for w in split(text)]
    shingles = ([b" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(prints):
    label = list(range(len(prints)))
    for _ in prints:
        before = list(label)
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    label[i] = min(label[i], label[j])
        if label == before:
            return label
    return label


def test_simhash_groups(docs, texts):
    got = Counter((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"])
                  for r in simhash.simhash_groups(docs).collect())
    prints = [brute_print(t[1]) for t in texts]
    label = brute_groups(prints)
    least = {}
    for (doc_id, *_), own in zip(texts, label):
        if doc_id is not None:
            least[own] = min(doc_id, least.get(own, doc_id))
    assert got == Counter((t[0], p, least.get(own)) for t, p, own in zip(texts, prints, label))
    kept = simhash.near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(label))


def test_simhash_pairs_are_dropped_by_the_count_alone(spark, monkeypatch, tmp_path):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(40)]
    flipped = lambda x, bits: x ^ sum(1 << b for b in bits)
    prints = list(base)
    for x in base:
        prints.append(flipped(x, rng.sample(range(64), 4)))         # near, in up to four bytes
        prints.append(flipped(x, rng.sample(range(64), 5)))         # one bit too far
        # three bytes shared, the others wholly different: met, but short of the minimum
        prints.append(x ^ int.from_bytes(bytes([0, 0, 0, *[255] * 5]), "little"))
        # shared bytes too few by one, and only one bit off in each of the others
        prints.append(flipped(x, [8 * b for b in range(5)]))
    prints = sorted(set(prints))
    counted = tmp_path / "counted"
    real = simhash.reaching

    def spied(fp, i, j, least):
        out = real(fp, i, j, least)
        with counted.open("a") as file:
            file.write(f"{len(i)} {len(out[0])}\n")
        return out

    monkeypatch.setattr(simhash, "reaching", spied)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    got = simhash.links(spark.createDataFrame(signed, "fp bigint")).collect()
    met, kept = (sum(x) for x in zip(*[map(int, line.split()) for line in counted.open()]))
    assert met - kept >= 40 and kept >= 40
    label = brute_groups(prints)
    groups = {p: l for p, l in zip(prints, label)}
    for src, dst in got:
        assert groups[src % (1 << 64)] == groups[dst % (1 << 64)]
    joined = {p: p for p in prints}
    for _ in prints:
        for src, dst in got:
            low = min(joined[src % (1 << 64)], joined[dst % (1 << 64)])
            joined[src % (1 << 64)] = joined[dst % (1 << 64)] = low
    assert len(set(joined.values())) == len(set(label))


@pytest.mark.parametrize("listed", [units.LISTED, 0])
def test_a_hot_bucket_is_dealt_without_meeting(spark, monkeypatch, listed, plan):
    """Most rows in one bucket: every pair meets once, no task reads more than its share."""
    monkeypatch.setattr(units, "LISTED", listed)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    n, limit = 3_000, 100
    rows = spark.range(n).select((F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 70)).alias("bucket"),
                                 F.col("id").alias("member"))
    dealt = units.deal(rows, ["bucket"], "member", limit)
    assert ("SortMergeJoin" in plan(dealt)) == (listed == 0)
    if listed == 0:  # by bucket and salt, not by bucket
        assert re.search(r"hashpartitioning\(bucket#\w+, _salt#", plan(dealt))
    sizes = [r["count"] for r in dealt.groupBy("bucket", "_lo", "_hi").count().collect()]
    assert max(sizes) < 3 * limit

    def pairs(rows, i, j):
        a, b = rows["member"][i], rows["member"][j]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))],
                                          ["a", "b"])

    found = dealt.mapInArrow(units.compare(["bucket"], pairs), "a bigint, b bigint").filter("a <> b")
    buckets = Counter(r["bucket"] for r in rows.collect())
    assert found.count() == found.distinct().count() == sum(k * (k - 1) // 2 for k in buckets.values())
    spark.conf.set(threshold, before)


def test_packing_round_trip(docs, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer
    encoder = Tokenizer.from_file(path)
    rows = packing.pack(docs, path).collect()
    pieces, sequences = {}, {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"]
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), Counter())[(r["start"], tuple(ids))] += 1
        sequences.setdefault((r["sequence_id"], r["context"]), []).append((r["offset"], r["length"]))
    want = Counter()
    for doc_id, text, *_ in texts:
        for i in encoder.encode(text or "", add_special_tokens=False).ids + [1]:
            want[(doc_id, i)] += 1
    found = Counter()
    for (doc_id, _), own in pieces.items():
        for (_, ids), n in own.items():
            for i in ids:
                found[(doc_id, i)] += n
    assert found == want
    short = 0
    for (_, context), parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= context <= 2048
        short += at < context
    assert short <= 1 and len(sequences) == len({k[0] for k in sequences})


def test_words_encode_as_the_text(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer
    encoder, rng = Tokenizer.from_file(path), random.Random(1)
    parts = ["a", "s", "t", "'", "'s", ".", ",", "!", "É", "ß", "İ", "1", " ", "\n", "\xa0",
             "́", "=", "̸", "<|", "<|endoftext|>", "…", "-", "中", "\x85", "LL", "ÿ", "÷", "é",
             "Å", "µ", "à", "\x0b", "Ａ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    want = [[*e.ids, 1] for e in encoder.encode_batch(texts, add_special_tokens=False)]
    for limit in (500_000, 100):  # also where the words known are given up again and again
        monkeypatch.setattr(packing, "_KNOWN_WORDS", limit)
        known, got = packing.WordIds(encoder, packing.folds_case(path), 1), []
        for at in range(0, len(texts), 500):
            column = pa.array([None, *texts, None]).slice(at + 1, 500)
            ids, bounds = known.encode(column)
            got += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        assert got == want
    assert known.encode(pa.array([None, ""]))[0].tolist() == [1, 1]


def test_cut_words_encode_as_the_text():
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer
    encoder, rng = Tokenizer.from_file(path), random.Random(2)
    parts = ["a", "S", "s", "t", "T", "H", "J", "re", "'", "$", ".", "@", "-", "=", "<", "|", ">", "<|",
             "É", "é", "ß", "Þ", "×", "÷", "ÿ", "À", "1", "23", " ", "\n", "\t", "\xa0", "\xad", "ª", "°",
             "\u0308", "\u030c", "\u0331", "\u0338", "\u0591", "\u1e9e", "Ǆ", "Σ", "’", "中", "😀", "\x85",
             "\x00", "İ", "ĳ", "\u200d", "٣"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(20_000)]
    # capitals whose small letter composes with the mark while they themselves do not
    texts += ["T\u0308a", "T\u0591\u0308", "H\u0331", "J\u030c", "W\u030a", "Y\u030a"]
    want = [[*e.ids, 1] for e in encoder.encode_batch(texts, add_special_tokens=False)]
    known, got = packing.WordIds(encoder, packing.folds_case(path), 1), []
    for at in range(0, len(texts), 3000):
        column = pa.array(["é", *texts]).slice(at + 1, 3000)
        ids, bounds = known.encode(column)
        got += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert got == want


def test_words_are_learned_without_their_signs():
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer
    encoder, rng = Tokenizer.from_file(path), random.Random(3)
    words = ["".join(rng.choices("abcdeéßñ", k=8)) for _ in range(300)]
    signs = ["", "$$$", "%%%", ",***", ".", "=12", ")"]
    texts = [before + word + sign for word in words for sign in signs for before in ("", "(", "É")]
    known = packing.WordIds(encoder, packing.folds_case(path), 1)
    ids, bounds = known.encode(pa.array(texts))
    want = [[*e.ids, 1] for e in encoder.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
    assert len(known.known) <= 2 * len(words) + len(signs) + 2


def test_mix_matches_targets_and_schedule(docs):
    sizes = mixing.sized(docs)
    shares = {r["source"]: r for r in mixing.targets(sizes).collect()}
    total = sum(r["total"] for r in shares.values())
    target = {s: 0.0 for s in shares}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(
        sorted(shares, key=lambda s: (s is None, s or "")))}
    open_, left = set(shares), float(total)
    while open_ and left > 1e-9:                    # reshare the excess round by round
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            target[s] += share * weight[s]
            if target[s] >= 3 * shares[s]["total"]:
                left += target[s] - 3 * shares[s]["total"]
                target[s] = 3.0 * shares[s]["total"]
                open_.remove(s)
    for s, r in shares.items():
        assert abs(r["target"] - target[s]) < 1e-6 * max(total, 1)
    rows = mixing.mix(docs, block_words=64, sizes=sizes).collect()
    taken, of_source = Counter(), Counter()
    for r in rows:
        assert 0 < r["stop"] - r["start"] <= 64
        taken[(r["id"], r["key"], r["copy"])] += r["stop"] - r["start"]
        of_source[r["source"]] += r["stop"] - r["start"]
    for r in sizes.collect():
        assert taken[(r["id"], r["key"], r["copy"])] <= 3 * r["size"]
    for s, r in shares.items():
        assert abs(of_source[s] - r["target"]) <= 1
    slots = sorted({(r["slot"], r["source"] or "~", r["block"]) for r in rows})
    blocks = {}
    for _, source, block in slots:                  # ranks count up with time
        assert block == blocks.get(source, 0)
        blocks[source] = block + 1
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(split(r["text"])) for r in mixed.collect()) == sum(of_source.values())


def test_context_trees_against_plain_recursion():
    rng = np.random.default_rng(0)
    counts = {name: Counter(bytes(rng.choice(list(letters), rng.integers(1, 9)).astype(np.uint8))
                            for _ in range(200)) for name, letters in
              (("x", b"abcde"), ("y", b"cdefg"))}
    trees = ppm.Trees(counts)

    def bits(name, word):
        grams = Counter()
        for w, n in counts[name].items():
            text = b" " + w + b" "
            for end in range(2, len(text) + 1):
                for size in range(1, min(5, end) + 1):
                    grams[text[end - size:end]] += n

        def cost(gram):
            if not gram:
                return 8.0
            after = {k: v for k, v in grams.items() if k[:-1] == gram[:-1]}
            total, kinds = sum(after.values()), len(after)
            if gram in grams:
                return -log2(grams[gram] / (total + kinds))
            return (-log2(kinds / (total + kinds)) if after else 0) + cost(gram[1:])

        text = b" " + word + b" "
        return sum(cost(text[max(end - 5, 0):end]) for end in range(2, len(text) + 1))

    words = [b"abc", b"zzz", b"a", b"cdefgz", b"gfedcbaabcdefg", "é".encode()]
    got = trees.words(words)
    for i, word in enumerate(words):
        for j, name in enumerate(trees.languages):
            assert abs(got[i, j] - bits(name, word)) < 1e-9


def test_language_of_awkward_rows(docs, texts):
    rows = ppm.language_of(docs).select("row.doc_id", "row.text", "lang_pred", "score").collect()
    assert len(rows) == len(texts)
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "en") == letters and 0 <= r["score"] <= 1
    assert ppm.keep_identified(docs).columns == docs.columns


def test_every_labelled_language_is_learned_within_the_sample(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda first: first + "".join(rng.choice("abcdefgh") for _ in range(7))
    languages = "qrstuvwx"
    rows = [(100 * k + i, " ".join(word(first) for _ in range(12)), first)
            for k, first in enumerate(languages) for i in range(3)]
    # one text with nearly all of a language's bytes, one without a blank
    rows += [(100 * k + 50, " ".join(word(first) for _ in range(30_000)), first)
             for k, first in enumerate(languages)]
    rows += [(900, "y" + "z" * 400_000, "y"), (901, "yz yz", "y"), (902, " \t\n", "blank")]
    rows += [(1000 + i, " ".join(word("m") for _ in range(100)), "m") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    learned = {}
    real = ppm.Trees

    def kept(counts, *rest):
        learned.update(counts)
        return real(counts, *rest)

    monkeypatch.setattr(ppm, "Trees", kept)
    limit = 1 << 14
    trees = ppm.train(docs, sample_bytes=limit)
    monkeypatch.undo()
    assert trees.languages == sorted([*languages, "y", "m"])
    for language, words in learned.items():
        size = sum(n * (len(w) + 1) for w, n in words.items())
        # what there is of it is used, and not much more
        assert 0.9 * limit < size < 1.2 * limit, (language, size)
    named = ppm.identify(docs, trees).select("row.lang", "lang_pred").collect()
    assert all(r["lang_pred"] == (r["lang"] if r["lang"] != "blank" else "und") for r in named)
    whole = [(i, "a b c " * 3_000, "all") for i in range(3)]
    learned.clear()
    monkeypatch.setattr(ppm, "Trees", kept)
    ppm.train(spark.createDataFrame(whole, docs.schema), sample_bytes=1 << 20)
    assert learned["all"] == Counter({w: 9_000 for w in (b"a", b"b", b"c")})


@pytest.mark.parametrize("labels", ["none", "held out"])
def test_documents_stay_where_no_language_was_learned(docs, texts, labels):
    lang = F.when(ppm.held_out(), F.col("lang")) if labels == "held out" else F.lit(None)
    table = docs.withColumn("lang", lang.cast("string"))
    kept = ppm.keep_identified(table)
    assert kept.columns == docs.columns
    want = Counter((i, t) for i, t, *_ in texts if any(c.isalpha() for c in t or ""))
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == want


@pytest.mark.parametrize("name,accuracy", [("language", 0.98), ("quality", 0.97)])
def test_held_out_accuracy(spark, name, accuracy):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    if name == "language":
        rows = ppm.language_of(table).filter(ppm.held_out("row.doc_id"))
        right = rows.select((F.col("row.lang") == F.col("lang_pred")).alias("ok"))
    else:
        labels = spark.read.parquet(f"{folder}/labels.parquet")
        rows = qda.quality(table, labels).filter("held_out").join(labels, "doc_id")
        right = rows.select((F.col("predicted") == F.col("quality")).alias("ok"))
    assert right.agg(F.avg(F.col("ok").cast("int"))).first()[0] >= accuracy


def test_quality_of_awkward_rows(spark, docs, texts):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    rows = qda.quality(docs, none).collect()
    assert len(rows) == len(texts) and all(r["score"] == 0.5 for r in rows)
    one = spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "doc_id bigint, quality int")
    assert all(0 <= r["score"] <= 1 for r in qda.quality(docs, one).collect())


def test_embedding_links_and_recall(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((800, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = []
    for cosine in (0.951, 0.96, 0.98):
        for _ in range(60):
            u, w = x[rng.integers(800)], rng.standard_normal(64)
            w -= (w @ u) * u
            near.append(cosine * u + np.sqrt(1 - cosine ** 2) * w / np.linalg.norm(w))
    x = np.concatenate([x, near, x[:20], 3 * x[:5]])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    bad = [(5000, None, 0), (5001, [0.0] * 64, 0), (5002, [float("nan")] + [1.0] * 63, 0)]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>, rep int")
    got = {r["vec_id"]: r for r in itq.near_vectors(df).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    want = linked.sum(axis=1)
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.98 * want.sum()
    for i, *_ in bad:
        assert got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"]
    assert len(got) == len(rows) + len(bad)


def test_vectors_of_another_length_link_with_nothing(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(30)]
    rows += [(100 + i, rows[i][1]) for i in range(5)]
    rows += [(200, [1.0, 2.0]), (201, [1.0, 2.0]), (202, []), (203, rows[0][1] + [0.0])]
    got = {r["vec_id"]: tuple(r) for r in itq.near_vectors(spark.createDataFrame(
        rows, "vec_id bigint, embedding array<double>")).collect()}
    assert len(got) == len(rows)
    for i in (200, 201, 202, 203):
        assert got[i] == (i, 0, i, True)
    assert all(got[100 + i][1:] == (1, i, False) for i in range(5))


def test_embedding_tables_grow_with_their_substrings(spark, monkeypatch):
    from math import ceil, comb
    p = np.arccos(0.95) / np.pi
    used, real = [], itq.fit

    def fit(sample, bits, *rest):
        used.append(bits)
        return real(sample, bits, *rest)

    monkeypatch.setattr(itq, "fit", fit)
    x = np.random.default_rng(2).standard_normal((40, 16))
    x[20:] = x[:20] + 0.01
    classes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                                    "rep bigint, vector array<double>")
    for n in (100_000, 4_000_000, 10_000_000, 100_000_000, 1_000_000_000):
        each = min(ceil(log2(n)) + 2, 31)
        found = itq.links(classes, 0.95, itq.TABLES, itq.SAMPLE, bits=each)
        tables = used.pop() // each
        missed = (1 - sum(comb(each, k) * p**k * (1 - p)**(each - k) for k in range(3)))**tables
        assert missed < 0.01 and (tables == itq.TABLES) == (n <= 4_000_000)
    assert {(r["a"], r["b"]) for r in found.collect()} >= {(i, i + 20) for i in range(20)}


def test_fingerprints_and_edits(docs, texts):
    rows = merkle.fingerprinted(docs).collect()
    assert len(rows) == len(texts)
    prints = {}
    text_of = {}
    for r in rows:
        prints.setdefault(r["fingerprint"], []).append(r["n_chars"])
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
    assert len(prints) == len({t[1] or "" for t in texts})


def test_fingerprints_of_short_texts_keep_what_is_unchanged(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    rows = []
    for i in range(240):
        n = rng.choice([4, 8, 15, 30, 60, 100, 300, 480, 700, 3000])
        text = ""
        while len(text) < n:
            text += word() + rng.choice([" ", " ", " ", ". ", "\n", "! "])
        rows.append((i, text[:n]))
    got = merkle.fingerprinted(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    text_of = dict(rows)
    for r in got:
        text, n = text_of[r["doc_id"]], r["n_chars"]
        cut = n - n // 4
        head = text_of[(r["doc_id"] + 1) % 240][:n // 4]
        assert r["edited"] == text[:cut] + head
        if len(head) == n // 4:  # as long as before, so paragraphs are cut alike
            assert r["near_edited"] > 0.5
            same = len(os.path.commonprefix([text, r["edited"]]))
            assert r["edit_start"] is None or same - 200 < r["edit_start"] <= same
        if r["edit_start"] is not None:
            assert r["edited"][:r["edit_start"]] == text[:r["edit_start"]]
            assert r["edit_start"] <= r["edit_end"] <= n
        else:
            assert r["edited"] == text


def test_edit_places_are_around_what_differs(spark):
    body = [f"Sentence {i} is here and says {i * 7}. " for i in range(400)]
    changes = [(0, 1), (399, 400), (200, 201), (100, 103), (0, 400), (150, 150)]
    rows = []
    for a, b in changes:
        other = body[:a] + [x.replace("here", "gone") for x in body[a:b]] + body[b:]
        if a == b:
            other = body[:a] + ["A new one. "] + body[a:]
        rows.append(("".join(body), "".join(other), len("".join(body[:a])), len("".join(body[:b]))))
    rows.append(("same. text", "same. text", None, None))
    df = spark.createDataFrame(rows, "a string, b string, first int, last int")
    one, two = F.col("one"), F.col("two")
    prints = df.withColumns({"one": merkle.fingerprint(F.col("a")),
                             "two": merkle.fingerprint(F.col("b"))}).cache()
    for r in prints.select("*", merkle.edit_places(one, two).alias("at"),
                           merkle.likeness(one, two).alias("near")).collect():
        if r["first"] is None:
            assert r["at"] is None and r["near"] == 1.0
            continue
        assert r["first"] - 96 <= r["at"]["start"] <= r["first"]
        # the blank behind a sentence belongs to the next
        assert r["last"] - 1 <= r["at"]["end"] <= r["last"] + 96
        changed = (r["last"] - r["first"]) / len(r["a"])
        assert abs(r["near"] - (1 - changed)) < 0.02


def test_warc_derivatives(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.b/c", "<title>T &amp; U</title><script>x</script><p>One<p>Two &lt;3"
          "<a href='/x'>go</a>", "z"), (2, None, None, "z"), (None, "u", "", "z")],
        "page_id bigint, url string, html string, block string")
    source = warc.responses(pages)
    rows = warc.derivatives(source.withColumn("block", F.lit(1))).collect()
    assert len(rows) == 6
    first = {r["record_type"]: r for r in rows if r["target_uri"] == "http://a.b/c"}
    assert first["conversion"]["block"] == "T & U\nOne\nTwo <3go"
    assert "title: T & U\r\noutlink: /x\r\n" in first["metadata"]["block"]
    response = source.filter("page_id = 1").first()
    assert {r["refers_to"] for r in first.values()} == {response["record_id"]}
    payload = "sha256:" + hashlib.sha256(response["payload"].encode()).hexdigest()
    for r in first.values():
        assert r["source_payload_digest"] == payload
        assert f"Content-Length: {len(r['block'].encode())}" in r["warc_header"]


def test_warc_decodes_every_reference_and_takes_every_link(spark):
    import html
    from html.entities import html5

    blank = dict.fromkeys(map(ord, "\xa0\t\n\r\f"), " ")
    names = [n for n in sorted(html5) if n.endswith(";")]
    numbers = ["#169;", "#xA9;", "#X1f600;", "#128;", "#0;", "#xD800;", "#160;", "#10;", "#13;",
               "#0000000000000000065;", "#x110000;", "#65", "copy", "notit;", "unknown;"]
    bodies = ["".join(f"<p>[&{n}]" for n in part) for part in (names, numbers)]
    bodies.append("<p>&amp;copy; &amp;amp;lt; &lt;b&gt; &#" + "9" * 5_000 + ";")
    tags = ["href=/bare", "class=x href=/b?a=1&copy=2&amp;c=3&lt", "HREF = /spaced", "href=/x/",
            """title="see href=no" href='/it"s'""", 'href="it\'s"', "data-href=no href=/yes",
            'title="a>b" href="&#x2F;&eacute;&notit;"', 'class="c"href="/close"', "name=top",
            "hreflang=en href=/lang", "href", "href=/one href=/two", 'href=""']
    tags += [f'href="{"/p" * 9}{"&eacute;" * 40_000}"', "x " * 40_000 + "href=/far"]
    bodies.append("".join(f"<a {t}>x</a>" for t in tags) + "<abbr href=/no>y</abbr>")
    pages = spark.createDataFrame([(i, f"u{i}", f"<title>&Eacute;&#33;</title>{b}")
                                   for i, b in enumerate(bodies)],
                                  "page_id bigint, url string, html string")
    rows = warc.derivatives(warc.responses(pages)).collect()
    got = {(int(r["target_uri"][1:]), r["record_type"]): r for r in rows}
    for i, part in enumerate((names, numbers)):
        lines = got[i, "conversion"]["block"].split("\n")[1:]
        assert lines == [f"[{html.unescape('&' + n).translate(blank)}]" for n in part]
    assert got[2, "conversion"]["block"].split("\n") == ["É!", "&copy; &amp;lt; <b> �"]
    assert all(got[i, "metadata"]["block"].startswith("title: É!\r\n") for i in range(4))

    block = got[3, "metadata"]["block"]
    links = [x[len("outlink: "):] for x in block.split("\r\n") if x.startswith("outlink: ")]
    assert links == ["/bare", "/b?a=1&copy=2&c=3<", "/spaced", "/x/", '/it"s', "it's", "/yes",
                     "/é&notit;", "/close", "/lang", "/one", "", "/p" * 9 + "é" * 40_000, "/far"]
    for r in rows:
        assert r["content_length"] == len(r["block"].encode())
        assert r["block_digest"] == "sha256:" + hashlib.sha256(r["block"].encode()).hexdigest()


def test_warc_repeats_and_what_is_not_closed(spark):
    pages = spark.createDataFrame(
        [(1, "u", f"<p>seen{tail}") for tail in (
            "<script>var x = 1; <p>no", "<STYLE>p {} <p>no", "<!-- no <p>no", "<script>a</script><!--b-->")
         for _ in range(2)], "page_id bigint, url string, html string")
    rows = warc.derivatives(warc.responses(pages)).collect()
    assert len(rows) == 16 and len({tuple(r) for r in rows}) == 8
    assert {r["block"] for r in rows if r["record_type"] == "conversion"} == {"seen"}


def test_url_lists_as_of(spark):
    from datetime import datetime as at
    entries = spark.createDataFrame([
        ("l", "x.example.com", "block", at(2024, 1, 2)), ("l", "x.example.com", "remove", at(2024, 1, 5)),
        ("m", "example.com", "review", at(2024, 1, 1)), ("m", "x.example.com/ok", "allow", at(2024, 1, 3)),
        (None, "q", "block", at(2024, 1, 1))],
        "list string, pattern string, action string, dated timestamp_ntz")
    url = "http://X.example.com:80/ok/p?q#f"
    captures = spark.createDataFrame([
        (1, url, at(2023, 12, 31)), (2, url, at(2024, 1, 2)), (3, url, at(2024, 1, 4)),
        (4, "http://x.example.com/", at(2024, 1, 5)), (5, None, at(2024, 1, 5)), (6, url, None),
        (7, "not a url", at(2024, 1, 5)), (2, url, at(2024, 1, 2))],
        "capture_id bigint, url string, fetched timestamp_ntz")
    got = [(r["capture_id"], r["verdict"], r["n_active"]) for r in
           urllists.as_of(captures, entries).collect()]
    assert sorted(got) == [(1, "unlisted", 0), (2, "block", 2), (2, "block", 2), (3, "allow", 3),
                           (4, "review", 1), (5, "unlisted", 0), (6, "unlisted", 0),
                           (7, "unlisted", 0)]
    assert urllists.as_of(captures, entries.limit(0)).count() == 8
    assert urllists.as_of(captures.limit(0), entries).count() == 0


def test_empty_tables(spark, empty):
    assert substring.remove_repeats(empty).count() == 0
    assert simhash.simhash_groups(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert packing.pack(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    assert ppm.language_of(empty).count() == 0
    assert merkle.fingerprinted(empty).count() == 0
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert qda.quality(empty, labels).count() == 0
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert itq.near_vectors(vectors).count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.derivatives(warc.responses(pages)).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        assert docs.columns == columns
        if name == "near_duplicates":
            prints = [(r["doc_id"], brute_print(r["text"])) for r in before.collect()]
            prints.sort()
            label = brute_groups([p for _, p in prints])
            assert {r["doc_id"] for r in docs.collect()} == {prints[i][0] for i in set(label)}
        if name == "repeated_passages":
            seen = Counter(tuple(w[i:i + 35]) for w in (split(r["text"]) for r in before.collect())
                           for i in range(len(w) - 34))
            lost = sum(n for n in seen.values() if n > 1)
            assert docs.count() == before.count() and (lost > 0) == (
                sum(len(split(r["text"])) for r in docs.collect())
                < sum(len(split(r["text"])) for r in before.collect()))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    from tokenizers import Tokenizer
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sum(len(encoder.encode(r["text"] or "", add_special_tokens=False).ids) + 1
               for r in docs.collect())
    assert packed.agg(F.sum("length")).first()[0] == want
