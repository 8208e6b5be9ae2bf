"""Each stage of the pipeline next to brute force on the stage's own input."""

import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq

import corpus_pipeline
from test_operators import brute_groups, check_packed
from wattgrid.session import staged

STRIP = " \t\n\x0b\x0c\r"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def without_shared_lines(rows):
    key = lambda x: lower(x.strip(STRIP))
    number = lambda i: -1 if i is None else i
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            holders[key(x)].add(number(i))
    stays = lambda i, x: len(key(x)) < 40 or len(holders[key(x)]) < 5 or max(holders[key(x)]) == number(i)
    return [(i, None if t is None else "\n".join(x for x in t.split("\n") if stays(i, x))) for i, t in rows]


def one_of_each_group(rows):
    sets, component = brute_groups(rows)
    return [(i, t) for i, t in rows if component[i] == i or not any(sets[i])]


def uncontaminated(rows, folder):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = set()
    for r in pq.read_table(f"{folder}/benchmark.parquet").to_pylist():
        w = words(r["text"])
        windows |= {tuple(w[k:k + 13]) for k in range(max(1, len(w) - 12) if w else 0)}
    out = []
    for i, t in rows:
        w, hit = words(t), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit.update(range(k, k + size))
        if not hit or 20 * len(hit) < len(w):
            out.append((i, t))
    return out


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    expected = [lambda rows: [r for r in rows if "zogbrat" not in (r[1] or "")], without_shared_lines, one_of_each_group, lambda rows: uncontaminated(rows, folder)]
    columns = docs.columns
    for (_, stage), brute in zip(corpus_pipeline.STAGES[:-1], expected, strict=True):
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        docs = staged(stage(spark, docs, folder))
        assert docs.columns == columns
        after = Counter((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
        assert after == Counter(brute(before)) and sum(after.values()) < len(before) + 1
    found = [r.asDict() for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()]
    assert {r["doc_id"] for r in found} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    check_packed(found, 2048)


def test_run(spark, folder, empty_folder):
    assert corpus_pipeline.run(spark, folder).count() > 50
    assert corpus_pipeline.run(spark, empty_folder).count() == 0
