"""Token alignment, hard negatives and exact dedup next to brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wattgrid.llm import alignment, exact_dedup, hard_negatives, perfect_hash, queries

QUERIES = {name: run for name, (run, _) in queries.QUERIES.items()}
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def same(found, expected):
    key = lambda r: repr(sorted(r.items()))
    assert Counter(map(key, found)) == Counter(map(key, expected))


def brute_tokens(texts):
    """Token ids and end offsets of whole texts, not cut into units; None where bytes are not given back."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    units = alignment.Tokens(PATHS)
    out = []
    for text in texts:
        raw = f" {text}".encode()
        x, y = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
        piece_x, piece_y = [units.bytes_a[i] for i in x], [units.bytes_b[i] for i in y]
        if not text or b"".join(piece_x) != raw or b"".join(piece_y) != raw:
            out.append(None)
        else:
            out.append((x, np.cumsum([len(p) for p in piece_x]).tolist(), y, np.cumsum([len(p) for p in piece_y]).tolist()))
    return out


def brute_alignment(documents):
    tokens = brute_tokens([t or "" for _, t in documents])
    linked, count = [], Counter()
    for t in tokens:
        links = []
        if t:
            x, end_x, y, end_y = t
            start_x, start_y = [0, *end_x[:-1]], [0, *end_y[:-1]]
            j = 0
            for i in range(len(x)):
                while end_y[j] <= start_x[i]:
                    j += 1
                k = j
                while k < len(y) and start_y[k] < end_x[i]:
                    links.append((x[i], y[k]))
                    k += 1
        linked.append(links)
        count.update(links)
    best = defaultdict(int)
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    out = []
    for (doc_id, _), t, links in zip(documents, tokens, linked):
        groups = []
        if t:
            x, end_x, y, end_y = t
            cuts, i, j = sorted(set(end_x) & set(end_y)), 0, 0
            for cut in cuts:
                own = [[], []]
                while i < len(x) and end_x[i] <= cut:
                    own[0].append(str(x[i]))
                    i += 1
                while j < len(y) and end_y[j] <= cut:
                    own[1].append(str(y[j]))
                    j += 1
                groups.append(",".join(own[0]) + "|" + ",".join(own[1]))
        out.append({
            "doc_id": doc_id, "n_a": len(t[0]) if t else 0, "n_b": len(t[2]) if t else 0, "n_groups": len(groups), "n_links": len(links),
            "n_best": sum(count[p] == best[p[1]] for p in links), "count_sum": sum(count[p] for p in links),
            "groups_sha256": hashlib.sha256(";".join(groups).encode()).hexdigest() if t else "",
        })
    return out


def odd_texts():
    rng = random.Random(3)
    parts = ["a", "word", "Words", "é", "日本語", " ", "  ", "   ", "\n", "\t", "\n\n", "　", "\xa0", "\x85", "\x1c", " ", "'s", "don't", "12", "1234567",
             "!", "...", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "<unk>", "ﬁ", "½", "😀", "\x00", "﻿", "é", "\r\n", "—", "ABCdef"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(400)]
    return texts + ["", " ", "  ", "a ", " a", "\n", "a\n b", "a \nb", "a\n  b", "▁", "a ▁ b", "a▁b", "\t x", "x" * 3000, "a b " * 3000]


def test_units_align_like_whole_texts(spark):
    documents = [(i, t) for i, t in enumerate(odd_texts())]
    frame = spark.createDataFrame([*documents, (None, None)], "doc_id bigint, text string")
    found = [r.asDict() for r in alignment.align(frame, PATHS).collect()]
    for r in found:
        groups = r.pop("groups")
        r["groups_sha256"] = hashlib.sha256(groups.encode()).hexdigest() if r["n_a"] else groups
    expected = brute_alignment([*documents, (None, None)])
    assert sum(r["n_a"] == 0 for r in expected) >= 5
    same(found, expected)


def test_op11(spark, folder, documents):
    found = [r.asDict() for r in QUERIES["op11_token_alignment"](spark, folder).collect()]
    same(found, brute_alignment(documents))


def test_op11_in_segments(spark, folder):
    """Several small segments give the same counts as one."""
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    one = [r.asDict() for r in alignment.align(frame, PATHS).collect()]
    many = alignment.align(frame, PATHS, segment_keys=300)
    same([r.asDict() for r in many.collect()], one)


def test_perfect_hash():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 30_000))
    parts = perfect_hash.class_of(keys, 7)
    built = [perfect_hash.build(keys[parts == p]) for p in range(7)]
    words = perfect_hash.packed(np.concatenate([b[1] for b in built]))
    function = perfect_hash.PerfectHash(np.array([b[0] for b in built]), words, np.concatenate([b[2] for b in built]))
    assert sorted(function.index(keys)) == list(range(len(keys)))
    others = np.setdiff1d(rng.integers(0, 1 << 40, 5000), keys)
    assert (function.index(others) == -1).all()
    assert len(words) * 64 < 5 * len(keys)


def test_perfect_hash_places_what_no_level_could(monkeypatch):
    monkeypatch.setattr(perfect_hash, "LEVELS", 1)
    keys = np.arange(0, 4000, 3)
    sizes, bits, order = perfect_hash.build(keys)
    function = perfect_hash.PerfectHash(sizes[None, :], perfect_hash.packed(bits), order)
    assert sorted(function.index(keys)) == list(range(len(keys)))
    assert (function.index(keys + 1) == -1).all()


def brute_negatives(table):
    rows = []
    for n, r in enumerate(table):
        if r["label"] is None or r["embedding"] is None or any(x is None or not math.isfinite(x) for x in r["embedding"]):
            continue
        label = (r["label"] + 1) % 10 if r["vec_id"] is not None and r["vec_id"] % 7 == 0 else r["label"]
        rows.append((n, r["vec_id"], label, [math.floor(256 * x) for x in r["embedding"]]))
    out = []
    for n, anchor, label, v in rows:
        if anchor is None or anchor % 100:
            continue
        scored = sorted(
            ((sum(a * b for a, b in zip(v, w)), m, i, other) for m, i, other, w in rows if m != n),
            key=lambda x: (-x[0], x[2] is None, x[2] or 0, x[1]),
        )
        for score, _, positive, _ in [x for x in scored if x[3] == label][:5]:
            inside = [x for x in scored if x[3] != label and 80 * score <= 100 * x[0] <= 100 * score][:5]
            for rank, (s, _, negative, _) in enumerate(inside, 1):
                out.append({"anchor_id": anchor, "positive_id": positive, "rank": rank, "negative_id": negative, "positive_score": score, "negative_score": s})
    return out


@pytest.mark.parametrize("blocks", [None, (2, 37, 1)])
def test_op12(spark, folder, monkeypatch, blocks):
    if blocks:
        for name, value in zip(("ANCHOR_BLOCK", "ROW_BLOCK", "STEP"), blocks):
            monkeypatch.setattr(hard_negatives, name, value)
    found = [r.asDict() for r in QUERIES["op12_hard_negatives"](spark, folder).collect()]
    expected = brute_negatives(pq.read_table(f"{folder}/embeddings.parquet").to_pylist())
    assert len(expected) > 60
    same(found, expected)


def test_op12_exact_beyond_doubles(spark):
    """Scores above 2^53 stay whole numbers; scores that may not fit stop the job."""
    big = 1 << 18
    rows = [(i, i % 2, [big * 256 + i, big * 255 - i]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id bigint, label bigint, v array<bigint>")
    anchor = F.col("vec_id") == 0
    found = {tuple(r) for r in hard_negatives.mine(frame, anchor).collect()}
    score = {i: sum(a * b for a, b in zip(rows[0][2], v)) for i, _, v in rows}
    order = sorted(range(1, 40), key=lambda i: (-score[i], i))
    expected = set()
    for p in [i for i in order if i % 2 == 0][:5]:
        for rank, i in enumerate([i for i in order if i % 2 and 80 * score[p] <= 100 * score[i] <= 100 * score[p]][:5], 1):
            expected.add((0, p, rank, i, score[p], score[i]))
    assert found == expected and expected
    huge = spark.createDataFrame([(i, i % 2, [1 << 40]) for i in range(8)], "vec_id bigint, label bigint, v array<bigint>")
    with pytest.raises(Exception, match="2\\^55"):
        hard_negatives.mine(huge, anchor).collect()


def brute_copies(documents):
    groups = defaultdict(list)
    for i, t in documents:
        groups[t or ""].append(i)
    return groups


@pytest.mark.parametrize("widths", [(128, 8), (1, 2)])
def test_op13(spark, folder, documents, widths):
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    found = [r.asDict() for r in exact_dedup.classes(frame, *widths).collect()]
    groups = brute_copies(documents)
    largest = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = [{"doc_id": i, "keep_id": largest[t], "group_size": len(ids), "text_sha256": sha(t)} for t, ids in groups.items() for i in ids]
    kept = Counter((r["text_sha256"], r["doc_id"]) for r in found if r["kept"])
    assert kept == Counter((sha(t), largest[t]) for t in groups)
    same([{k: v for k, v in r.items() if k != "kept"} for r in found], expected)


def test_op13_shared_beginnings(spark):
    """Texts that agree for long, end inside one another, or differ in the last byte."""
    base = "é" * 900
    texts = [base[:k] for k in (0, 1, 23, 24, 25, 48, 383, 384, 385, 900)] * 2 + [base + c for c in "abca"] + ["a\x00", "a", "a\x00\x00", "A", "a "]
    documents = list(enumerate(texts))
    frame = spark.createDataFrame(documents, "doc_id bigint, text string")
    found = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.classes(frame).collect()}
    groups = brute_copies(documents)
    assert found == {i: (max(groups[t]), len(groups[t]), i == max(groups[t])) for i, t in documents}


def test_op13_remove_keeps_rows(spark, folder, documents):
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    left = exact_dedup.remove(frame)
    assert left.columns == frame.columns
    groups = brute_copies(documents)
    assert Counter((r["text"] or "", r["doc_id"]) for r in left.collect()) == Counter((t, max((i for i in ids if i is not None), default=None)) for t, ids in groups.items())
    same([r.asDict() for r in left.exceptAll(frame).collect()], [])
