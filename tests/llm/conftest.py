import math
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

KIND = pa.schema([
    ("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()),
    # Names that the operators use themselves.
    ("id", pa.string()), ("t", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("row", pa.string()), ("key", pa.string()),
    ("spans", pa.string()), ("label", pa.string()), ("kept", pa.string()), ("drop", pa.string()), ("n", pa.int64()),
])


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def corpus():
    """About 150 documents: prose, copies, near copies, shared lines and passages, odd texts."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgimnoprstu") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    line = "This Line of more than forty characters is held by many documents, always."
    passage = prose(rng, 90, words)
    texts = [prose(rng, rng.randint(3, 160), words) for _ in range(60)]
    texts += [texts[i] for i in range(8)]  # exact copies
    for i in range(8, 20):  # near copies
        w = texts[i].split()
        if len(w) > 60:
            w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    texts += [f"{texts[i]}\n{line if i % 2 else '  ' + line.upper() + ' '}\n" for i in range(30, 40)]
    texts += [f"{prose(rng, 30, words)} {passage} {prose(rng, 30, words)}" for _ in range(4)]
    texts += ["x" * 1500, "ab" * 900, "", None, None, "one", "One", "two words", "two  words", "a b c d e", "A b\tc d e", "a b c d e f", "\n\n", "   ", "é" * 700, *["日本 " * n for n in (300, 10, 20, 30, 40)]]
    texts += [prose(rng, 40_000, words)]  # very long
    texts += ["Mail a.b@c.de or x@y, 10.0.0.1 999.1.1.1 4111 1111 1111 1111, +49 (30) 123-4567-8 +1 2", "a@b.com_c@d.com 1.2.3.4.5.6.7.8"]
    texts += ["You are all zogbrat and flurmog, " + prose(rng, 20, words) for _ in range(10)]
    ids = list(range(len(texts)))
    rows = [(i, t) for i, t in zip(ids, texts)]
    rows += [(3, texts[3]), (3, "another text under a repeated id, with more words"), (None, texts[5]), (None, None)]  # repeated and NULL ids
    return rows, words


@pytest.fixture(scope="session")
def folder(tmp_path_factory):
    """Tables with NULLs, ties, repeats and extra columns."""
    rows, words = corpus()
    rng = random.Random(6)
    path = tmp_path_factory.mktemp("tables")

    def save(name, table):
        pq.write_table(table, path / f"{name}.parquet")

    columns = {f.name: [None] * len(rows) for f in KIND}
    columns["doc_id"], columns["text"] = [r[0] for r in rows], [r[1] for r in rows]
    columns["lang"] = [None if i % 7 == 0 else "ja" if t and "日" in t else "xx" for i, (_, t) in enumerate(rows)]
    columns["n"] = list(range(len(rows)))
    save("documents", pa.table(columns, schema=KIND))
    base = [r[1] for r in rows]
    items = [(1, " ".join(base[40].split()[5:40])), (2, "one"), (3, None), (4, ""), (1, " ".join(base[40].split()[5:40])), (None, base[41])]
    save("benchmark", pa.table({"item_id": pa.array([i for i, _ in items], pa.int64()), "text": pa.array([t for _, t in items], pa.string()), "hits": [0] * len(items)}))
    labels = [(r[0], 1, int("zogbrat" in (r[1] or ""))) for r in rows] + [(1, None, None), (None, 0, 1), (5000, 0, 1)]
    save("labels", pa.table({"doc_id": pa.array([x[0] for x in labels], pa.int64()), "quality": [x[1] for x in labels], "toxic": pa.array([x[2] for x in labels], pa.int32())}))
    turns = []
    for c in range(12):
        roles = ["system"] * (c % 3 == 0) + ["user", "assistant"] * rng.randint(1, 3)
        turns += [(c, k, role, prose(rng, 6, words)) for k, role in enumerate(roles)]
    turns += [(20, 0, "user", None), (20, 1, None, "no role"), (20, 1, "tool", "<s>[INST] \\1 \\0 </s>[TEXT]"), (None, None, "user", ""), (21, 5, "assistant", "first"), (21, 5, "assistant", "first")]
    save("conversations", pa.table({"conv_id": pa.array([x[0] for x in turns], pa.int64()), "turn": pa.array([x[1] for x in turns], pa.int64()), "role": [x[2] for x in turns], "text": [x[3] for x in turns], "state": ["s"] * len(turns)}))
    vectors = [[rng.gauss(0.1, 0.3) for _ in range(6)] for _ in range(500)]
    table = [(i, rng.randint(0, 3), v) for i, v in enumerate(vectors)]
    table += [(600 + i, rng.randint(0, 3), vectors[i % 9]) for i in range(60)]  # ties
    table += [(100, 2, vectors[3]), (100, 2, vectors[3]), (None, 1, vectors[4]), (None, 1, vectors[100]), (None, None, vectors[5])]  # repeats, NULL ids
    table += [(901, None, vectors[0]), (902, 1, None), (903, 1, [None] + vectors[1][1:]), (904, 1, [math.inf] + vectors[1][1:]), (905, 1, [math.nan] + vectors[1][1:])]
    table += [(700, 8, vectors[7]), (-100, 1, vectors[8]), (906, 1, [0.0] * 6), (800, 1, [-x for x in vectors[9]])]
    save("embeddings", pa.table({
        "vec_id": pa.array([x[0] for x in table], pa.int64()), "embedding": pa.array([x[2] for x in table], pa.list_(pa.float32())),
        "label": pa.array([x[1] for x in table], pa.int32()), "v": ["x"] * len(table), "at": list(range(len(table))), "score": [0.5] * len(table),
    }))
    return str(path)


@pytest.fixture(scope="session")
def empty_folder(folder, tmp_path_factory):
    path = tmp_path_factory.mktemp("empty")
    for name in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        pq.write_table(pq.read_table(f"{folder}/{name}.parquet").slice(0, 0), path / f"{name}.parquet")
    return str(path)


@pytest.fixture(scope="session")
def documents(folder):
    table = pq.read_table(f"{folder}/documents.parquet")
    return list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))
