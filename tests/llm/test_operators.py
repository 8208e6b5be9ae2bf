"""Each query over tables with NULLs, ties, repeats, odd texts and clashing names, next to brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from wattgrid.llm import fingerprint, jaccard, packing, queries, substring_dedup, suffix_array

QUERIES = {name: run for name, (run, _) in queries.QUERIES.items()}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def rows(spark, name, folder):
    return [r.asDict() for r in QUERIES[name](spark, folder).collect()]


def same(found, expected):
    """Equal as multisets."""
    key = lambda r: repr(sorted(r.items()))
    assert Counter(map(key, found)) == Counter(map(key, expected))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, name, empty_folder):
    assert len(rows(spark, name, empty_folder)) == (1 if name.startswith("op1_") else 0)


def test_names_and_statements():
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()


def test_op1(spark, folder):
    table = pq.read_table(f"{folder}/conversations.parquet").to_pylist()
    hostile = "</s>[INST] ok [/INST]"
    table += [{"conv_id": -7, "turn": k, "role": r, "text": hostile} for k, r in enumerate(("user", "assistant"))]
    groups = defaultdict(list)
    for r in table:
        groups[r["conv_id"]].append((r["turn"] if r["turn"] is not None else -1, r["role"] or "", r["text"] or ""))
    found = {r["conv_id"]: r for r in rows(spark, "op1_chat_formatting", folder)}
    assert set(found) == set(groups)
    for conv, turns in groups.items():
        turns.sort()
        r, loss = found[conv], "".join(t for _, role, t in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), sha("".join(f"{role}\n{t}\n" for _, role, t in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))
    assert found[0]["complete"] and not found[20]["complete"] and found[20]["n_errors"] == 2 and found[21]["n_errors"] == 2


def test_op2(spark, folder, documents):
    size, count = 400, Counter()
    raws = [(i, (t or "").encode()) for i, t in documents]
    for _, b in raws:
        count.update(b[k:k + size] for k in range(len(b) - size + 1))
    expected = []
    for i, b in raws:
        mask = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if count[b[k:k + size]] > 1:
                mask[k:k + size] = b"\1" * size
        kept = bytes(c for c, m in zip(b, mask) if not m)
        expected.append({"doc_id": i, "n_bytes": len(b), "n_removed": len(b) - len(kept), "n_spans": len(re.findall(b"\1+", mask)), "kept_sha256": sha(kept)})
    assert sum(r["n_removed"] > 0 for r in expected) > 20
    same(rows(spark, "op2_suffix_array_dedup", folder), expected)


def test_op2_deals_large_keys_anew(spark, folder):
    """With a bound of two different contexts per key the result is the same."""
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    key = lambda r: (r["id"] is None, r["id"], r["t"])

    def union(r):
        return substring_dedup._merged([s.asDict() for s in r["spans"]])

    plain = {key(r): union(r) for r in substring_dedup.covered(frame).collect()}
    assert {key(r): union(r) for r in substring_dedup.covered(frame, most_contexts=1).collect()} == plain


def test_op2_finds_keys_once(spark, monkeypatch):
    """The keys of a document are computed once, however often they are read."""
    made, plain = spark.sparkContext.accumulator(0), substring_dedup._keys

    def counted(documents):
        def watch(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        keys = plain(documents)
        return keys.mapInArrow(watch, keys.schema)

    text = "".join(map(str, range(300)))
    frame = spark.createDataFrame([(1, text), (2, text), (3, text[::-1])], "doc_id long, text string")
    once = plain(frame).count()
    monkeypatch.setattr(substring_dedup, "_keys", counted)
    spans = {r["id"]: substring_dedup._merged([s.asDict() for s in r["spans"]]) for r in substring_dedup.covered(frame).collect()}
    assert spans == {1: [(0, len(text))], 2: [(0, len(text))]}
    assert made.value == once


@pytest.mark.parametrize("most", [4096, 1])
def test_op2_leaves_no_contexts_behind(spark, monkeypatch, folder, most):
    """Contexts are stored once, not copied, and gone once the spans are found."""
    stored, plain = [], substring_dedup.staged

    def watched(df):
        stored.append(plain(df))
        return stored[-1]

    monkeypatch.setattr(substring_dedup, "staged", watched)
    spans = substring_dedup.covered(spark.read.parquet(f"{folder}/documents.parquet"), most_contexts=most)
    assert spans.count() > 0
    held = [f for f in stored if "context" in f.columns]
    assert len(held) == 1 if most > 1 else len(held) > 1
    folders = {f.inputFiles()[0].rsplit("/", 1)[0] for f in held}
    assert not any(spark.read.parquet(path).count() for path in folders)


def test_suffix_arrays_of_repetitive_texts_are_sorted():
    """Copies that differ in few places: many names in the reduced string, long common beginnings."""
    rng = np.random.default_rng(3)
    base = rng.integers(2, 258, 3000)
    parts = [base, base, np.where(rng.random(3000) < 0.01, 257, base), np.full(500, 7), base[:700]]
    text = np.concatenate([np.append(p, 1) for p in parts] + [[0]]).astype(np.uint16)
    raw = text.astype(">u2").tobytes()
    expected = sorted(range(len(text)), key=lambda i: raw[2 * i:])
    assert suffix_array.suffix_array(text, 258).tolist() == expected
    names = np.unique(text[:9000], return_inverse=True)[1]
    assert suffix_array._by_doubling(names).tolist() == sorted(range(len(names)), key=lambda i: names[i:].tolist())


def brute_groups(documents):
    sets = defaultdict(set)
    for i, t in documents:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        s = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
        sets[i].add(s)
    nodes = [(i, s) for i, group in sets.items() for s in group]
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(nodes):
        for j, r in nodes[:k]:
            if s and r and 100 * len(s & r) >= 75 * len(s | r):
                a, b = sorted((root(i), root(j)), key=lambda x: (x is not None, x))
                parent[b] = a
    return sets, {i: root(i) for i in sets}


def test_op3(spark, folder, documents):
    found = rows(spark, "op3_jaccard_join", folder)
    _, component = brute_groups(documents)
    assert len(found) == len(documents)
    assert {(r["doc_id"], r["component_id"]) for r in found} == set(component.items())
    assert len({c for i, c in component.items() if i != c}) > 10


def test_op3_boundary_and_small_sets(spark):
    """Sets of every small size around the boundary: subsets and prefixes find the same links."""
    texts = []
    for n in range(1, 26):
        words = [f"w{n}x{k}" for k in range(n + 4)]
        texts += [" ".join(words), " ".join(words[:-1] + ["end"]), " ".join(words[: max(5, n)])]
    documents = [(i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(documents, "doc_id bigint, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.groups(frame).collect()}
    assert found == brute_groups(documents)[1]


def test_op3_counts_all_links(spark, documents, monkeypatch):
    """Links inside a group count as well, also across the blocks of a component."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 4)
    words = [f"w{k}" for k in range(120)]
    near = [(1000 + k, " ".join(words[:20 * k + 9] + ["odd"] + words[20 * k + 10:])) for k in range(6)]  # all similar to all
    near += [(1100 + k, " ".join([f"v{j}" for j in range(k, 120 + k)])) for k in range(0, 60, 6)]  # a chain
    rows_in = documents + near + [(1200, near[0][1])]
    frame = spark.createDataFrame(rows_in, "doc_id bigint, text string")
    shingles = [(i, next(iter(brute_groups([(0, t)])[0][0]))) for i, t in rows_in]
    apart = {s for _, s in shingles if s}
    alike = lambda s, r: s != r and 100 * len(s & r) >= 75 * len(s | r)
    linked = {s: sum(alike(s, r) for r in apart) for s in apart}
    found = jaccard.groups(frame).select("doc_id", "n_shingles", "n_links").collect()
    assert Counter(map(tuple, found)) == Counter((i, len(s), linked.get(s, 0)) for i, s in shingles)
    assert all(linked[s] >= 5 for i, s in shingles if i in range(1000, 1006))
    low = lambda x: (x is not None, x or 0)
    named = {s: min((i for i, r in shingles if r == s), key=low) for s in apart}
    pairs = Counter(tuple(sorted((named[s], named[r]), key=low)) for s in apart for r in apart if alike(s, r))
    assert Counter(map(tuple, jaccard.pairs(frame).collect())) == Counter({p: n // 2 for p, n in pairs.items()})


def test_op3_large_sets_meet_only_where_bitmaps_of_their_size_fit(spark, monkeypatch):
    """Large texts that begin alike share lists; whole sets are loaded for possible links only, and none is lost."""
    rng = np.random.default_rng(3)
    head = [f"h{k}" for k in range(2300)]
    documents = []
    for k in range(24):  # similarity of 0.6: too little, but in the same lists
        documents.append((k, " ".join(head + [f"w{x}" for x in rng.integers(0, 10**9, 700)])))
    for k in range(12):  # edited more and more, across the boundary and across two widths of bitmaps
        words = documents[k][1].split()
        keep = len(words) - 40 * k
        documents.append((100 + k, " ".join(words[:keep] + [f"e{k}x{j}" for j in range(60 * k)])))
    documents += [(200 + k, " ".join(f"m{j}" for j in range(n))) for k, n in enumerate((400, 513, 520, 600, 680, 1020, 1030, 1300))]
    asked = []
    verified = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda docs, pairs: asked.append(pairs.count()) or verified(docs, pairs))
    frame = spark.createDataFrame(documents, "doc_id bigint, text string")
    found = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in jaccard.groups(frame).collect()}
    sets, component = brute_groups(documents)
    sets = {i: next(iter(s)) for i, s in sets.items()}
    links = {i: sum(i != j and s != r and 100 * len(s & r) >= 75 * len(s | r) for j, r in sets.items()) for i, s in sets.items()}
    assert found == {i: (component[i], links[i]) for i in sets}
    assert 5 < sum(links[k] > 0 for k in range(12)) < 12
    assert sum(asked) < 60  # 276 pairs of too little similarity share lists


def test_op4(spark, folder, documents):
    found = rows(spark, "op4_toxicity", folder)
    assert len(found) == len(documents) and all(0 <= r["score"] <= 1 for r in found)
    for r in found:
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 4 == 2)
        assert r["predicted"] == int(r["score"] >= 0.3)
    marked = {i for i, t in documents if "zogbrat" in (t or "")}
    assert {r["doc_id"] for r in found if r["predicted"]} == marked


def test_op4_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    truth = dict(zip(*(pq.read_table(f"{sf}/labels.parquet")[c].to_pylist() for c in ("doc_id", "toxic"))))
    held = sorted((r["score"], truth[r["doc_id"]]) for r in rows(spark, "op4_toxicity", sf) if r["held_out"] and r["doc_id"] in truth)
    ones, ranks = sum(y for _, y in held), sum(k for k, (_, y) in enumerate(held, 1) if y)
    assert (ranks - ones * (ones + 1) / 2) / (ones * (len(held) - ones)) > 0.95


def test_op5(spark, folder, documents):
    strip = " \t\n\x0b\x0c\r"
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(strip))
    holders = defaultdict(set)
    for i, t in documents:
        for x in (t or "").split("\n"):
            holders[key(x)].add(i)
    top = lambda s: max((-1 if i is None else i) for i in s)
    expected = []
    for i, t in documents:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 40 or len(holders[key(x)]) < 5 or top(holders[key(x)]) == (-1 if i is None else i)]
        expected.append({"doc_id": i, "n_lines": len(lines), "n_dropped": len(lines) - len(kept), "kept_sha256": sha("\n".join(kept))})
    assert sum(r["n_dropped"] for r in expected) >= 9
    same(rows(spark, "op5_line_dedup", folder), expected)


def base_spans(text):
    def luhn(s):
        doubled = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(reversed(s))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    return [(k, *m.span()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text or "") if ok(m.group())]


def test_op6(spark, folder, documents):
    expected = []
    for i, t in documents:
        spans = base_spans(t)
        n = Counter(s[0] for s in spans)
        expected.append({"doc_id": i, **{f"n_{k}": n[k] for k in ("email", "ip", "card", "phone")}, "base_sha256": sha(",".join(":".join(map(str, s)) for s in spans))})
    found = rows(spark, "op6_pii", folder)
    same([{k: v for k, v in r.items() if k != "spans"} for r in found], expected)
    assert sum(r["n_email"] for r in expected) == 3


def test_op6_marks_terms_that_reveal_an_entity(spark):
    import random

    from wattgrid.llm import pii

    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [f"{say(12)} Zwolin {say(2)} zw@mail.example.org {say(12)}" for _ in range(6)] + [f"{say(20)} zwolin."]
    texts += [f"{say(5)} common {say(5)} k{i}@mail.example.org {say(5)}" for i in range(40)] + [f"common {say(20)}" for _ in range(60)]
    copied = f"{say(10)} rareword {say(3)} c@mail.example.org {say(10)}"
    texts += [copied] * 9
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = pii.scan(frame)
    marked = {r["doc_id"]: [texts[r["doc_id"]][s["start"]:s["end"]].lower() for s in r["spans"] if s["kind_no"] == 5] for r in found.collect()}
    assert {i for i, m in marked.items() if m} == set(range(7)) and all(set(m) == {"zwolin"} for m in marked.values() if m)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(frame, found).collect()}
    assert "zw" not in clean[0].lower().split() and "[email]" in clean[0] and "olin" not in clean[6]


def test_op6_marks_terms_anywhere_in_the_document(spark):
    """A surname in the heading, far from the address and under the same signature each time."""
    import random

    from wattgrid.llm import pii

    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    sign = "kind regards from the office on the third floor please write to qx@mail.example.org or call us any day in the week"
    texts = [f"Qarlsby {say(60)} {sign}" for _ in range(5)] + [f"{say(60)} {sign.replace('qx@', f'k{i}@')}" for i in range(30)] + [say(60) for _ in range(30)]
    texts += [f"Copyname {say(60)} rr@mail.example.org"] * 8
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    marked = {r["doc_id"]: {texts[r["doc_id"]][s["start"]:s["end"]] for s in r["spans"] if s["kind_no"] == 5} for r in pii.scan(frame).collect()}
    assert {i: m for i, m in marked.items() if m} == {i: {"Qarlsby"} for i in range(5)}


def test_op7(spark, folder, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for i, t in documents:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = ids[k:k + 2048]
            expected[(i, k // 2048, k, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)))] += 1
    found = rows(spark, "op7_packing", folder)
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == expected
    check_packed(found, 2048)


def check_packed(found, capacity):
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_op7_exchange_between_partitions_saves_sequences(spark):
    import random

    from wattgrid.session import staged

    rng = random.Random(2)
    lengths = [rng.choice([90, 170, 400, 700, 1300, rng.randint(1, 2048)]) for _ in range(1500)]
    items = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    items = staged(items)
    dealt = [r.asDict() for r in packing.pack(items, per_partition=100).collect()]
    alone = [r.asDict() for r in packing.pack(items, per_partition=100, rounds=1).collect()]
    assert sorted(r["doc_id"] for r in dealt) == list(range(1500))
    bound = packing.fractional_bound(np.array(lengths), 2048)
    together = max(packing.best_fit_decreasing(sorted(lengths, reverse=True), 2048)[0]) + 1
    assert bound <= together <= check_packed(dealt, 2048) < check_packed(alone, 2048)


def test_op8(spark, folder, documents):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for r in pq.read_table(f"{folder}/benchmark.parquet").to_pylist():
        w = words(r["text"])
        for k in range(max(1, len(w) - 12) if w else 0):
            windows["" if r["item_id"] is None else str(r["item_id"])].add(tuple(w[k:k + 13]))
    expected = []
    for i, t in documents:
        w, hit, items = words(t), set(), set()
        for item, group in windows.items():
            for k in range(len(w)):
                for size in {len(x) for x in group}:
                    if tuple(w[k:k + size]) in group and k + size <= len(w):
                        hit.update(range(k, k + size))
                        items.add(item)
        expected.append({"doc_id": i, "n_words": len(w), "n_hit": len(hit), "n_items": len(items), "items_sha256": sha(",".join(sorted(items))), "contaminated": len(hit) > 0 and 20 * len(hit) >= len(w)})
    assert sum(r["contaminated"] for r in expected) >= 3
    same(rows(spark, "op8_decontamination", folder), expected)


def test_op8_in_blocks_of_items(spark, folder, monkeypatch):
    from wattgrid.llm import decontaminate

    plain = rows(spark, "op8_decontamination", folder)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    same(rows(spark, "op8_decontamination", folder), plain)


def test_op8_offsets(spark):
    from wattgrid.llm import decontaminate

    text = "Über — the  Quick, brown fox!! end"
    found = decontaminate.scan_text(text, decontaminate.automaton([("7", "quick BROWN fox")], 13))
    assert [text[h["start"]:h["stop"]] for h in found["hits"]] == ["Quick, brown fox"] and found["items"] == ["7"]


def test_op9(spark, folder, documents):
    found = rows(spark, "op9_language", folder)
    assert len(found) == len(documents)
    texts = Counter()
    for i, t in documents:
        texts[(i, t is not None and any(map(str.isalpha, t)))] += 1
    assert Counter((r["doc_id"], r["lang_pred"] != "und") for r in found) == texts
    assert all(0 <= r["score"] <= 1 for r in found)
    japanese = {i for i, t in documents if t and "日" in t}
    assert {r["doc_id"] for r in found if r["lang_pred"] == "ja"} == japanese


def test_op9_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = dict(zip(*(pq.read_table(f"{sf}/documents.parquet")[c].to_pylist() for c in ("doc_id", "lang"))))
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in rows(spark, "op9_language", sf) if r["held_out"]]
    assert sum(held) / len(held) > 0.97


def test_op10(spark, folder, documents):
    found = rows(spark, "op10_fingerprints", folder)
    assert len(found) == len(documents)
    ids = sorted({i for i, _ in documents if i is not None})
    following = dict(zip(ids, ids[1:] + ids[:1]))
    first = {i: [t or "" for j, t in documents if j == i] for i in ids}
    expected = Counter()
    for i, t in documents:
        t = t or ""
        size = len(t) // 4
        need = max(len(x) // 4 for x in first[i]) if i is not None else 0
        head = min(x[:need] for x in first[following[i]]) if i is not None else ""
        expected[(i, len(t), sha(t[: len(t) - size] + head[:size]))] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == expected
    marks = {}
    for r in found:
        marks.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    by_text = defaultdict(set)
    for i, t in documents:
        if i not in (3, None):
            by_text[t or ""] |= marks[i]
    assert all(len(m) == 1 for m in by_text.values()) and by_text[""] == {"0" * 16}
    distance = lambda x, y: bin(int(x, 16) ^ int(y, 16)).count("1")
    for r in found:
        assert r["near_edited"] == 1 - distance(r["fingerprint"], r["edited_fingerprint"]) / 64
        if r["doc_id"] is not None and r["doc_id"] % 50 == 0:
            assert r["n_near"] == sum(distance(r["fingerprint"], x["fingerprint"]) <= fingerprint.RADIUS for x in found) - 1
        else:
            assert r["n_near"] is None


def test_op10_words_chunks_and_copies(spark):
    """A text over several chunks gives the fingerprint of its plain votes."""
    words = [f"w{k % 977}q{k % 13}" for k in range(20_000)]
    frame = spark.createDataFrame([(1, " ".join(words)), (1, " ".join(words))], "key int, text string")
    value = fingerprint.fingerprints(frame).collect()
    assert len(value) == 1
    pairs = spark.createDataFrame(list(zip(words, words[1:] + [None])), "a string, b string")
    singles = [r[0] for r in pairs.selectExpr("xxhash64(a)").collect()]
    doubles = [r[0] for r in pairs.where("b is not null").selectExpr("xxhash64(a, b)").collect()]
    votes = [sum((h >> j) & 1 for h in singles) + 2 * sum((h >> j) & 1 for h in doubles) for j in range(64)]
    expected = sum(1 << j for j in range(64) if 2 * votes[j] > len(singles) + 2 * len(doubles))
    assert value[0]["fingerprint"] % (1 << 64) == expected


def test_near_pairs_are_complete(spark):
    import random

    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(40)]
    for v in values[:30]:
        w = v
        for _ in range(rng.randint(1, 5)):
            w ^= 1 << rng.randrange(64)
        values.append(w)
    values = sorted({v - (1 << 64) if v >= 1 << 63 else v for v in values})
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint bigint")
    found = Counter((r["left"], r["right"]) for r in fingerprint.near_pairs(frame, frame).collect())
    close = lambda x, y: 0 < bin((x ^ y) % (1 << 64)).count("1") <= 3
    assert found == Counter((x, y) for x in values for y in values if close(x, y))


def test_components(spark):
    from wattgrid.llm import components

    edges = [(k, k + 1) for k in range(100, 160)] + [(5, 1), (1, 5), (5, 5), (None, 3), (9, 5)] + [(1000, k) for k in range(1001, 1100)]
    found = dict(components.labels(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert found == {**{k: 100 for k in range(100, 161)}, 1: 1, 5: 1, 9: 1, **{k: 1000 for k in range(1000, 1100)}}
