r"""Personal data: patterns for the protected entities, information theory for the terms that reveal them.

Base spans are e-mail addresses, IP addresses, payment cards and telephone numbers, found by pattern
(leftmost, non-overlapping per kind) and checked. Each distinct value is a protected entity. From the
whole corpus we count in how many documents an entity e, a word t and both together occur, all three by
the different words of whole documents; the disclosure of e by t is ``PMI(t, e) / IC(e)`` with
``PMI = log(N n(t, e) / (n(t) n(e)))`` and ``IC = log(N / n(e))``: 1 if t never occurs without e. A word
that discloses an entity to ``DISCLOSURE`` or more, in at least ``LEAST_SUPPORT`` independent documents, is
marked wherever it occurs (kind ``term``). Copies of a text are not independent: documents whose word sets
have the same ``SKETCH`` minima of hashes count as one, so an entity in one page and its copies marks nothing.

``sanitise`` generalises base spans to their kind and removes marked terms. DataFrame functions only.

A NULL or empty text has no spans. Documents are counted by ``doc_id`` and text, so repeated rows count
once and each row gets its result; extra columns are ignored (``sanitise`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattgrid.session import staged

KINDS = ("email", "ip", "card", "phone")
DISCLOSURE = 0.8
LEAST_SUPPORT = 3.0
SKETCH = 3

# The stated patterns. Possessive repeats and the look-behind change no match: they spare retries inside
# a run of characters that cannot lead to one, and deep recursion on long runs.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINTS = {"email": "@", "ip": ".", "phone": "+"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP = rf"\A{_PART}(?:\.{_PART}){{3}}\z"
_TERM = r"\p{L}{3,}"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    doubled = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substr(F.reverse(digits), i, F.lit(1)).cast("int") * (2 - i % 2),
    )
    return F.aggregate(doubled, F.lit(0), lambda acc, d: acc + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(_IP)
    size = F.length(_digits(match))
    if kind == "card":
        return F.when(size.between(13, 19), _luhn(_digits(match))).otherwise(False)
    return size.between(9, 15) if kind == "phone" else F.lit(True)


def _identified(documents: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("t"), text.alias("text"))


def _placed(found: DataFrame) -> DataFrame:
    """Rows ``id, t, kind, at, gap, match`` get ``start, end``: gaps and matches follow one another."""
    before = Window.partitionBy("id", "t", "kind").orderBy("at")
    ends = F.sum(F.col("gap") + F.length("match")).over(before.rowsBetween(Window.unboundedPreceding, 0))
    placed = found.withColumn("end", ends.cast("bigint"))
    return placed.withColumn("start", F.col("end") - F.length("match"))


def _matches(kind: str) -> Column:
    """All matches of a kind's pattern in ``text``, in order: the match, its number and the length of the
    gap before it."""
    none = F.array().cast("array<string>")
    some = F.contains("text", F.lit(_HINTS[kind])) if kind in _HINTS else F.lit(True)
    matches = F.when(some, F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0))).otherwise(none)
    gaps = F.when(F.size(matches) > 0, F.split("text", PATTERNS[kind], -1)).otherwise(none)
    return F.transform(matches, lambda m, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("at"), F.length(F.get(gaps, i)).alias("gap"), m.alias("match"),
    ))


def _matched(documents: DataFrame) -> DataFrame:
    """``id, t, text, m``: the documents with matches, valid or not."""
    rows = _identified(documents)
    rows = rows.where(F.col("text").rlike("[0-9]") | F.contains("text", F.lit("@")))
    parts = [_matches(kind) for kind in KINDS]
    return rows.select("id", "t", "text", F.flatten(F.array(*parts)).alias("m")).where(F.size("m") > 0)


def base_spans(documents: DataFrame) -> DataFrame:
    """``id, t, kind, start, end, match``: valid matches, once for each document text (``t`` is its
    hash)."""
    found = _matched(documents).select("id", "t", "m")
    once = found.groupBy("id", "t").agg(F.first("m").alias("m"))
    placed = _placed(once.select("id", "t", F.inline("m")))
    valid = F.lit(False)
    for kind in KINDS:
        valid = F.when(F.col("kind") == kind, _valid(kind, F.col("match"))).otherwise(valid)
    return placed.where(valid).select("id", "t", "kind", "start", "end", "match")


def _contexts(documents: DataFrame, spans: DataFrame, support: float) -> tuple[DataFrame, DataFrame]:
    """``entities, words, mark`` of each document that holds an entity, where copies share the mark; and
    ``entity, n_e``. An entity in fewer than ``support`` documents cannot have a term and is left out."""
    mentions = spans.select(F.lower("match").alias("entity"), "id", "t").distinct()
    often = staged(mentions.groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= support))
    each = mentions.join(often.select("entity"), "entity").groupBy("id", "t").agg(F.collect_list("entity").alias("entities"))
    each = each.select(F.col("id").alias("e_id"), F.col("t").alias("e_t"), "entities")
    met = _matched(documents).select("id", "t", "text").join(each, F.col("id").eqNullSafe(F.col("e_id")) & (F.col("t") == F.col("e_t")))
    once = met.select("id", "t", "text", "entities").dropDuplicates(["id", "t"])
    mark = F.xxhash64(*map(_least_hash, range(SKETCH)))
    return staged(once.withColumn("words", _words()).select("entities", "words", mark.alias("mark"))), often


def _least_hash(salt: int) -> Column:
    return F.array_min(F.transform("words", lambda w: F.xxhash64(w, F.lit(salt))))


def _pairs(contexts: DataFrame) -> DataFrame:
    """``entity, term, mark``: each entity with each word of a document that holds it."""
    return contexts.select(F.explode("entities").alias("entity"), "words", "mark").select("entity", F.explode("words").alias("term"), "mark")


def revealing_terms(documents: DataFrame, spans: DataFrame, disclosure: float = DISCLOSURE, support: float = LEAST_SUPPORT) -> DataFrame:
    """``term``: the words that disclose some entity. ``spans`` must be a stored table."""
    contexts, often = _contexts(documents, spans, support)
    each = _pairs(contexts).groupBy("entity", "term").agg(F.count("*").alias("n_te")).where(F.col("n_te") >= support)
    pairs = each.join(often, "entity")
    rows = _identified(documents)
    total = rows.select("id", "t").distinct().count()
    # Document counts of the words over the whole corpus.
    counts = _distinct_words(rows).groupBy("term").agg(F.count("*").alias("n_t"))
    judged = pairs.join(counts, "term")
    information = F.log(F.lit(float(max(total, 1))) / F.col("n_e"))
    pmi = F.log(F.lit(float(max(total, 1))) * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    close = staged(judged.where((information > 0) & (pmi >= F.lit(disclosure) * information)).select("entity", "term"))
    marks = _pairs(contexts).join(close, ["entity", "term"]).groupBy("entity", "term", "mark").count()
    independent = marks.groupBy("entity", "term").agg(F.count("*").alias("n"))
    return independent.where(F.col("n") >= support).select("term").distinct()


def _words() -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_TERM), F.lit(0)))


def _distinct_words(rows: DataFrame) -> DataFrame:
    return rows.select("id", "t", F.explode(_words()).alias("term"))


def term_spans(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """``id, t, kind, start, end`` of each occurrence of the terms, outside and inside of base spans.
    ``terms`` must be a stored table."""
    rows = _identified(documents)
    held = staged(_distinct_words(rows).join(terms, "term").distinct())
    texts = rows.join(held, ["id", "t"])
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})"), F.col("term"), F.lit(r"(?!\p{L})"))
    found = texts.select("id", "t", "term", F.regexp_extract_all("text", pattern, F.lit(0)).alias("m"), F.split("text", pattern, -1).alias("g"))
    pieces = F.transform("m", lambda m, i: F.struct(i.alias("at"), F.length(F.get(F.col("g"), i)).alias("gap"), m.alias("match")))
    once = found.groupBy("id", "t", "term").agg(F.first(pieces).alias("p"))
    placed = _placed(once.select("id", "t", F.col("term").alias("kind"), F.inline("p")))
    return placed.select("id", "t", F.lit("term").alias("kind"), "start", "end")


def scan(documents: DataFrame, disclosure: float = DISCLOSURE, support: float = LEAST_SUPPORT) -> DataFrame:
    """``doc_id, t, spans``: for each document row all spans as ``kind_no, start, end``, sorted by kind
    (as in ``KINDS``, terms last) and start. Terms inside or across base spans are left out."""
    base = staged(base_spans(documents))
    terms = staged(revealing_terms(documents, base, disclosure, support))
    number = F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "term")]), F.col("kind"))
    spans = base.select("id", "t", "kind", "start", "end").unionByName(term_spans(documents, terms))
    sorted_spans = F.array_sort(F.collect_set(F.struct(number.cast("int").alias("kind_no"), "start", "end")))
    per_doc = spans.groupBy("id", "t").agg(sorted_spans.alias("all"))
    firsts = F.filter("all", lambda s: s["kind_no"] <= len(KINDS))
    apart = F.filter("all", lambda s: (s["kind_no"] <= len(KINDS)) | ~F.exists(firsts, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    per_doc = per_doc.select("id", "t", apart.alias("spans"))
    rows = documents.select(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_t"))
    joined = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row_t") == F.col("t")), "left")
    empty = F.array().cast("array<struct<kind_no:int,start:bigint,end:bigint>>")
    return joined.select("doc_id", F.col("row_t").alias("t"), F.coalesce("spans", empty).alias("spans"))


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*KINDS, "term")])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind_no"] - 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with base spans generalised to ``[kind]`` and marked terms removed; of overlapping
    spans the one that starts first counts. ``found`` is the result of ``scan``."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS], F.lit(""))
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind_no"].alias("kind_no"))))
    text = F.col("row.text")
    out = F.aggregate(
        by_start,
        F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct(
            F.concat(acc["done"], F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.get(names, s["kind_no"] - 1)).alias("done"),
            s["end"].alias("at"),
        )),
        lambda acc: F.concat(acc["done"], F.substr(text, (acc["at"] + 1).cast("int"), F.length(text))),
    )
    once = found.dropDuplicates(["doc_id", "t"]).select(F.col("doc_id").alias("f_id"), F.col("t").alias("f_t"), "spans")
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    joined = rows.join(once, F.col("row.doc_id").eqNullSafe(F.col("f_id")) & (F.xxhash64(F.coalesce("row.text", F.lit(""))) == F.col("f_t")), "left")
    return joined.select(F.col("row").withField("text", out).alias("row")).select("row.*")
