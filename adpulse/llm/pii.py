"""Personal data and the terms that give it away, in SQL expressions only.

Base spans are e-mail addresses, IPv4 addresses, payment-card numbers (Luhn) and
international phone numbers, found by pattern in whole texts.

The information-theoretic part treats every value found as a protected entity.
Around each occurrence the words within ``CONTEXT`` characters co-occur with it.
With N rows, n_e with the entity, n_t with the term and n_et with the term in
the entity's context, the entity's information content is log(N / n_e) and the
pointwise mutual information log(N n_et / (n_e n_t)); their ratio, at most 1, is
the share of the entity that the term discloses.  A term with at least
``SUPPORT`` different texts behind it is generalised from ``GENERALISE`` on and
removed from ``REMOVE`` on, wherever in the corpus it stands: with the entity
blacked out, it would still point to it.  Support counts different texts, so
copies of one document prove nothing; the frequencies count all rows.

Positions come from ``split`` and ``regexp_extract_all`` at the same matches: the
prefix sums of both arrays' lengths, taken by a window inside one document.
Patterns are written with possessive quantifiers and start at the beginning of
a run, so a match neither backtracks nor recurses however long the text is.

Null texts count as empty.  Rows are known by two hashes of id and text (``rows_of``),
which every scan computes alike; rows that repeat both have the same spans, and each
counts in the frequencies.  Null ids are fine.
Documents without spans have counts 0 and an empty list.  Empty tables give
empty results.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import SPACE, WORD, stored, text_or_empty

CONTEXT = 80
SUPPORT = 3
GENERALISE = 0.8
REMOVE = 0.95

_LOCAL = r"[A-Za-z0-9._%+-]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _n_digits(value: Column, low: int, high: int) -> Column:
    return F.length(_digits(value)).between(low, high)


#: Kind: pattern, what every text with a match also matches (a quick look), and the test of a match.
#: ``\G`` is the end of the match before, from which the next one may start at once.
KINDS = {
    "email": (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@[A-Za-z0-9-]++\.",
              lambda v: F.lit(True)),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]",
           lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){13}",
             lambda v: F.when(_n_digits(v, 14, 19), F.call_function("luhn_check", _digits(v))).otherwise(False)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", lambda v: _n_digits(v, 10, 15)),
}

_MATCH = ("array<struct<number:int,kind:string,i:int,value:string,gap:int,before:string,after:string,valid:boolean>>")
_PIECES = "array<struct<value:string,gap:string>>"
#: A match has at least two characters, so no context reaches over more of them.
_REACH = CONTEXT // 2


def _pieces(text: Column, kind: str) -> Column:
    """A kind's matches, each with the text since the match before, and after the last
    one the rest with a null match; null for texts that a quick look rules out."""
    pattern, look, _ = KINDS[kind]
    pieces = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"),
                          F.split(text, pattern, -1).alias("gap"))
    return F.when(text.rlike(look), pieces).cast(_PIECES)


def _matches(pieces: Column, number: int, kind: str) -> Column:
    """The matches in ``pieces`` with the lengths of the gaps before them and, if
    valid, the ``CONTEXT`` characters of text on both sides, other matches included."""
    valid = KINDS[kind][2]

    def joined(first: Column, n: Column, end) -> Column:
        """Some pieces as text, gap before match; ``end`` cuts them to what a context can hold."""
        return F.array_join(F.transform(F.slice(pieces, first, n), lambda p: F.concat(
            end(p["gap"], F.lit(CONTEXT)), F.coalesce(end(p["value"], F.lit(CONTEXT)), F.lit("")))), "")

    def match(m: Column, i: Column) -> Column:
        first = F.greatest(i - _REACH, F.lit(0))
        before = F.right(F.concat(joined(first + 1, i - first, F.right), F.right(m["gap"], F.lit(CONTEXT))), F.lit(CONTEXT))
        after = F.left(joined(i + 2, F.lit(_REACH + 1), F.left), F.lit(CONTEXT))
        good = valid(m["value"])
        return F.struct(F.lit(number).alias("number"), F.lit(kind).alias("kind"), i.alias("i"), m["value"].alias("value"),
                        F.length(m["gap"]).alias("gap"), F.when(good, before).alias("before"),
                        F.when(good, after).alias("after"), good.alias("valid"))
    return F.transform(F.filter(pieces, lambda p: p["value"].isNotNull()), match).cast(_MATCH)


def rows_of(docs: DataFrame) -> DataFrame:
    """``doc_id, text, row_id`` of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.withColumn("row_id", F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64("text", "doc_id").alias("b")))


def base_spans(rows: DataFrame) -> DataFrame:
    """``row_id, text_hash, number, kind, start, end, value, before, after, copies`` of every valid match;
    ``copies`` rows share the ``row_id``."""
    text = F.col("text")
    pieces = rows.select("row_id", F.xxhash64("text").alias("text_hash"), *(_pieces(text, k).alias(k) for k in KINDS))
    found = pieces.select("row_id", "text_hash", *(_matches(F.col(k), n, k).alias(k) for n, k in enumerate(KINDS)))
    nothing = F.array().cast(_MATCH)
    kept = [F.when(F.exists(k, lambda m: m["valid"]), F.col(k)).otherwise(nothing) for k in KINDS]
    found = found.select("row_id", "text_hash", F.explode(F.concat(*kept)).alias("m")).select("row_id", "text_hash", "m.*")
    found = found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("copies"))
    upto = Window.partitionBy("row_id", "number").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(upto).cast("long")
    return (found.withColumn("end", end).filter("valid")
            .withColumn("start", F.col("end") - F.length("value"))
            .select("row_id", "text_hash", "number", "kind", "start", "end", "value", "before", "after", "copies"))


#: Letters, marks and digits, with single hyphens, apostrophes, dots or underlines between them.
_SIGNS = r"[\p{L}\p{M}\p{N}]++"
_TERM = rf"^[\p{{P}}\p{{S}}]*+({_SIGNS}(?:[-'\u2019._]{_SIGNS})*+)[\p{{P}}\p{{S}}]*+$"


def _term(word: Column) -> Column:
    """A lower-case word without the punctuation around it ("jsmith42", "acct-10023", "o'brien"); empty
    if something else is inside (a slash, an at sign) or only one character is left."""
    found = F.regexp_extract(word, _TERM, 1)
    return F.when(F.length(found) > 1, found).otherwise("")


def _terms(text: Column) -> Column:
    """The distinct terms of a text (with the empty one if other words are there)."""
    return F.array_distinct(F.transform(F.split(F.lower(text), SPACE), _term))


def _term_rows(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``row_id`` and the columns of ``terms`` for every row that has one of them.
    The stored table's size decides whether it is sent to the rows or both are dealt out by term."""
    return rows.select("row_id", F.explode(_terms(F.col("text"))).alias("term")).join(terms, "term")


def disclosing_terms(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``term, action`` of the terms to generalise or remove."""
    entity = spans.select("row_id", "text_hash", F.concat_ws(":", "kind", F.lower("value")).alias("entity"),
                          "before", "after", "copies")
    # A word that the context's border cuts is left out.
    before = F.when(F.length("before") == CONTEXT, F.regexp_replace("before", "^" + WORD, "")).otherwise(F.col("before"))
    after = F.when(F.length("after") == CONTEXT, F.regexp_replace("after", WORD + "$", "")).otherwise(F.col("after"))
    near = entity.select("entity", "row_id", "text_hash", "copies",
                         F.explode(_terms(F.concat(before, F.lit(" "), after))).alias("term")).filter("term <> ''")
    together = (near.groupBy("entity", "term", "row_id").agg(F.first("text_hash").alias("text_hash"), F.first("copies").alias("copies"))
                .groupBy("entity", "term", "text_hash").agg(F.sum("copies").alias("rows"))
                .groupBy("entity", "term").agg(F.sum("rows").alias("n_et"), F.count(F.lit(1)).alias("texts"))
                .filter(F.col("texts") >= SUPPORT))
    per_entity = entity.select("entity", "row_id", "copies").distinct().groupBy("entity").agg(F.sum("copies").alias("n_e"))
    pairs = stored(together.join(per_entity, "entity"), "pairs")
    looked_at = stored(pairs.select("term").distinct(), "terms")
    per_term = _term_rows(rows, looked_at).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    n = rows.agg(F.count(F.lit(1)).alias("n"))
    content = F.log(F.col("n") / F.col("n_e"))
    shared = F.log(F.col("n") * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    disclosed = (pairs.join(per_term, "term").crossJoin(F.broadcast(n))  # one row
                 .filter(content > 0).groupBy("term").agg(F.max(shared / content).alias("share")))
    return (disclosed.filter(F.col("share") >= GENERALISE)
            .select("term", F.when(F.col("share") >= REMOVE, "removed").otherwise("generalised").alias("action")))


def term_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``row_id, number, kind, start, end`` of every occurrence of a disclosing term outside the base ``spans``."""
    actions = stored(disclosing_terms(rows, spans), "actions")
    wanted = stored(_term_rows(rows, actions).groupBy("row_id").agg(
        F.map_from_entries(F.collect_set(F.struct("term", "action"))).alias("actions")), "wanted")
    # One of the rows that share a key.
    words = (rows.join(wanted, "row_id").groupBy("row_id").agg(F.first("text").alias("text"), F.first("actions").alias("actions"))
             .select("row_id", "actions", F.posexplode(F.regexp_extract_all(
                 "text", F.lit(f"{SPACE}|{WORD}"), F.lit(0))).alias("i", "word")))
    upto = Window.partitionBy("row_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    words = words.withColumn("upto", F.sum(F.length("word")).over(upto).cast("long"))
    term = _term(F.lower("word"))
    # Punctuation before the term is not part of the span.
    lead = F.length(F.regexp_extract("word", r"^[\p{P}\p{S}]*+", 0))
    found = (words.withColumn("kind", F.try_element_at("actions", term)).filter("kind is not null")
            .withColumn("start", F.col("upto") - F.length("word") + lead)
            .select("row_id", F.lit(len(KINDS)).alias("number"), "kind", "start",
                    (F.col("start") + F.length(term)).alias("end")))
    taken = spans.groupBy("row_id").agg(F.collect_list(F.struct("start", "end")).alias("taken"))
    inside = F.exists("taken", lambda s: (s["start"] < F.col("end")) & (F.col("start") < s["end"]))
    return found.join(taken, "row_id", "left").filter(~F.coalesce(inside, F.lit(False))).drop("taken")


def _listed(spans: Column) -> Column:
    """``kind:start:end``, by start and then kind."""
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row."""
    rows = rows_of(docs)
    base = stored(base_spans(rows), "base")
    terms = stored(term_spans(rows, base), "term-spans")
    place = F.struct("start", "number", "kind", "end")
    every = base.select("row_id", "number", "kind", "start", "end").unionByName(terms)
    per_row = every.groupBy("row_id").agg(
        *(F.count(F.when(F.col("number") == i, 1)).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        _listed(F.collect_list(F.when(F.col("number") < len(KINDS), place))).alias("base"),
        _listed(F.collect_list(place)).alias("spans"))
    return rows.select("row_id", "doc_id").join(per_row, "row_id", "left").select(
        "doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"))


def sanitised(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with every span blacked out: base values as ``[kind]``,
    generalised terms as ``[term]``, removed terms as nothing."""
    rows = rows_of(docs)
    base = stored(base_spans(rows), "base")
    every = stored(base.select("row_id", "number", "kind", "start", "end").unionByName(term_spans(rows, base)), "spans")
    # Overlapping spans are one, named after the first.
    before = Window.partitionBy("row_id").orderBy("start", "number")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    grouped = (every.withColumn("new", (F.col("start") >= F.coalesce(reach, F.lit(0))).cast("int"))
               .withColumn("group", F.sum("new").over(before)))
    merged = grouped.groupBy("row_id", "group").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                                    F.min_by("kind", F.struct("start", "number")).alias("kind"))
    last = F.lag("end", 1, 0).over(Window.partitionBy("row_id").orderBy("start"))
    mark = (F.when(F.col("kind") == "removed", "").when(F.col("kind") == "generalised", "[term]")
            .otherwise(F.concat(F.lit("["), F.col("kind"), F.lit("]"))))
    cuts = merged.withColumn("from", last).groupBy("row_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "from", "end", mark.alias("mark")))).alias("cuts"))
    pieces = F.array_join(F.transform("cuts", lambda c: F.concat(
        F.substring(F.col("text"), (c["from"] + 1).cast("int"), (c["start"] - c["from"]).cast("int")), c["mark"])), "")
    rest = F.substring(F.col("text"), (F.element_at("cuts", -1)["end"] + 1).cast("int"), F.length("text"))
    return (rows.join(cuts, "row_id", "left")
            .select("doc_id", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.concat(pieces, rest)).alias("text")))
