"""Personal data: base patterns, and terms of their surroundings that give a protected entity away. Built-in functions only.

Base matches (email, ip, card, phone) are found on the whole text. Each is a protected entity. Terms are runs of three or
more letters outside base matches. Over the whole corpus, documents with a term, with an entity and with both are counted,
anywhere in the text. A term discloses an entity if all of this holds:

* the term informs: knowing it, the entity is `GAIN` bits less surprising, log2 p(entity | term) / p(entity). Words that stand in
  documents with and without the entity alike gain nothing, however common the entity is. No entity is left out for being common; one
  in more than 2^-`GAIN` of all documents (0.71) has fewer bits of surprise than a term must take away;
* the other way round, the term stands in at least `COVER` of the entity's documents;
* the two stand together in at least `SUPPORT` different texts, and the term there has at least `SUPPORT` different words before and after it:
  exact copies, near copies and fixed phrases (a footer's "write to") prove nothing;
* little surprise is left: -log2 p(entity | term) is at most `REMOVE` bits, then the term goes from every place of every document, or
  `GENERALISE` bits, then it is replaced by the class of its form ([NAME] with a capital, [ACRONYM], else [TERM]) at every place
  of the documents that hold the entity. In documents without it such a term points to other things as well, and stays.

Pairs and terms are counted with partial aggregation by 64-bit hashes. Entities that stand in the same documents count as
one (told by two XORs of hashes of their documents), so a directory of thousands of addresses does not meet each
of its words thousands of times. Counts alone show that most terms cannot disclose any entity of their document; these are
dropped before they meet entities, and no result is lost. Patterns are possessive and begin only where a run begins or the last match
ended, which finds the same matches as the plain patterns in time linear in the text.

Defined results: null text counts as empty and stays null in `sanitised`; rows without doc_id are scanned like others; repeated rows get equal results
and count as documents each; extra columns are carried by `sanitised` and ignored by `scan`; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsieve.llm.store import written

SUPPORT = 2
#: Bits: least gain by a term, most that is left for generalising and removing (shares 0.5 and 0.9).
GAIN, GENERALISE, REMOVE = 0.5, 1.0, 0.152
COVER = 0.1
#: Bits of surprise that an entity needs so that a term can gain `GAIN`, and documents added to the corpus for its estimate: no further bound.
SURPRISE, PRIOR = GAIN, 0
KINDS = ("email", "ip", "card", "phone", "term", "removed")
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}{3,}"
_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = F.reverse(_digits(match))

    def worth(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    # the length is checked first: longer runs are no cards
    return F.when(F.length(digits).between(12, 19), F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0).otherwise(False)


def _byte_parts(match: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return F.when(F.length(bare) <= 3, F.when(bare == "", "0").otherwise(bare).cast("int") <= 255).otherwise(False)
    return F.forall(F.split(match, r"\."), small)


_PASSES = {
    "email": lambda m: F.lit(True),
    "ip": _byte_parts,
    "card": _luhn,
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def _places(text: Column, pattern: str, kind: int, passes, offset: Column | int = 0) -> Column:
    """Spans of the matches that pass: what lies between matches, and the matches, add up to their places."""
    gaps, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    offset = F.lit(offset).cast("int") if isinstance(offset, int) else offset.cast("int")
    start = F.struct(offset.alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["gaps"])
        end = begin + F.length(pair["matches"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(passes(pair["matches"]), F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    pairs = F.filter(F.arrays_zip(gaps.alias("gaps"), matches.alias("matches")), lambda p: p["matches"].isNotNull())
    return F.aggregate(pairs, start, step)["spans"]


def base_spans(text: Column) -> Column:
    """All base spans, by start, then kind; code points from 0, end exclusive."""
    none = F.array().cast(_SPAN)
    has = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), "phone": text.rlike(r"\+[0-9]")}
    found = [F.when(has[k], _places(text, PATTERNS[k], i, _PASSES[k])).otherwise(none) for i, k in enumerate(PATTERNS)]
    return F.array_sort(F.concat(*found))


def _masked(text: Column, base: Column) -> Column:
    """The text with spaces in place of its base spans, of the same length."""
    def step(acc: Column, span: Column) -> Column:
        at, end = acc["at"], F.greatest(acc["at"], span["end"])
        out = F.concat(acc["out"], F.substring(text, at + 1, span["start"] - at), F.repeat(F.lit(" "), end - F.greatest(at, span["start"])))
        return F.struct(end.alias("at"), out.alias("out"))

    done = F.aggregate(base, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return F.when(F.size(base) == 0, text).otherwise(F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))


def _term(match: Column) -> Column:
    return F.xxhash64(F.lower(match))


def _scanned(docs: DataFrame, kept: list[str]) -> DataFrame:
    """(row: struct of the kept columns, uid, text_hash, base, entities, masked), written."""
    text = F.coalesce(F.col("text"), F.lit(""))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.monotonically_increasing_id().alias("uid"), text.alias("text"))
    row = row.withColumn("base", base_spans(F.col("text")))
    entities = F.transform("base", lambda s: F.xxhash64(s["kind"], F.lower(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]))))
    return written(row.select("row", "uid", F.xxhash64("text").alias("text_hash"), "base", F.array_distinct(entities).alias("entities"),
                              _masked(F.col("text"), F.col("base")).alias("masked")), "scanned")


def _revealing(scanned: DataFrame) -> DataFrame:
    """(uid, hits): terms of a document to remove or to generalise, by hash.

    Small tables that cut large ones are written before, so that their size is known when the join is planned.
    """
    corpus = scanned.count()
    found = F.transform(F.regexp_extract_all("masked", F.lit(TERM), F.lit(0)), _term)
    words = scanned.select("uid", F.explode(F.array_distinct(found)).alias("term"))
    terms = written(words.groupBy("term").agg(F.count("*").alias("with_term")).where(F.col("with_term") >= SUPPORT), "terms")

    holding = scanned.where(F.size("entities") > 0)
    held = holding.select("uid", "text_hash", F.explode("entities").alias("entity"))
    sets = [F.bit_xor(F.xxhash64("uid", F.lit(i))).alias(f"set{i}") for i in (1, 2)]  # equal for equal sets of documents
    entities = held.groupBy("entity", "text_hash").agg(F.count("*").alias("docs"), *sets).groupBy("entity").agg(
        F.sum("docs").alias("docs"), F.bit_xor("set1").alias("set1"), F.bit_xor("set2").alias("set2"), F.count("*").alias("texts"))
    common = (corpus + PRIOR) * 2.0**-SURPRISE  # what stands in more documents gains, or lets gain, less than GAIN
    entities = entities.where((F.col("texts") >= SUPPORT) & (F.col("docs") <= common))
    entities = entities.groupBy("docs", "set1", "set2").agg(F.min("entity").alias("entity")).select("entity", F.col("docs").alias("with_entity"))
    held = written(held.drop("text_hash").join(entities, "entity"), "entities")

    # a share of 2^-GENERALISE needs at least as many documents with the entity; COVER bounds the other way round
    left = 2.0**-GENERALISE
    most = held.groupBy("uid").agg(F.max("with_entity").alias("most"), F.min("with_entity").alias("fewest"))
    near = holding.join(most, "uid").select("uid", "text_hash", "most", "fewest", F.explode(F.array_distinct(found)).alias("term")).join(terms, "term")
    near = near.where((F.col("with_term") <= common) & (F.col("with_term") * left <= F.col("most")) & (F.col("with_term") >= COVER * F.col("fewest")))
    near = near.drop("most", "fewest")
    pairs = near.join(held, "uid").where((F.col("with_term") * left <= F.col("with_entity")) & (F.col("with_term") >= COVER * F.col("with_entity")))
    # least and greatest hash tell of SUPPORT (two) different texts, and let the pairs of a common entity shrink before they are shuffled
    counted = pairs.groupBy("entity", "term", "with_term", "with_entity").agg(
        F.count("*").alias("docs"), F.min("text_hash").alias("t0"), F.max("text_hash").alias("t1"))
    share = F.col("docs") / F.col("with_term")
    chosen = counted.where((F.col("t0") != F.col("t1")) & (share >= left) & (F.col("docs") >= COVER * F.col("with_entity"))
                           & (share * corpus >= 2.0**GAIN * F.col("with_entity")))
    chosen = written(chosen.select("entity", "term", (share >= 2.0**-REMOVE).alias("removed")), "pairs")

    # the words before and after, in the documents of the entity
    asked = held.join(chosen, "entity").select("uid", "entity", "term", "removed")
    where = written(asked.select("uid").distinct(), "documents")
    around = F.transform("f", lambda t, i: F.struct(t.alias("term"), F.coalesce(F.get("f", i - 1), F.lit(0)).alias("before"), F.coalesce(F.get("f", i + 1), F.lit(0)).alias("after")))
    placed = holding.join(where, "uid", "left_semi").select("uid", found.alias("f")).select("uid", F.inline(around))
    placed = placed.join(written(chosen.select("term").distinct(), "chosen"), "term", "left_semi")
    asked = written(placed.groupBy("uid", "term").agg(
        *[agg(c).alias(f"{c}_{name}") for c in ("before", "after") for name, agg in (("low", F.min), ("high", F.max))]).join(asked, ["uid", "term"]), "places")
    varied = asked.groupBy("entity", "term").agg(F.min("before_low").alias("b0"), F.max("before_high").alias("b1"), F.min("after_low").alias("a0"), F.max("after_high").alias("a1"))
    varied = written(varied.where("b0 <> b1 AND a0 <> a1").select("entity", "term"), "revealing")
    disclosing = written(asked.join(varied, ["entity", "term"]).select("uid", "term", "removed"), "disclosing")
    everywhere = written(disclosing.where("removed").select("term").distinct(), "removed")
    gone = words.join(everywhere, "term").select("uid", "term", F.lit(True).alias("removed"))
    hits = gone.unionByName(disclosing.where("NOT removed")).groupBy("uid", "term").agg(F.max("removed").alias("removed"))
    return hits.groupBy("uid").agg(F.collect_list(F.struct("term", "removed")).alias("hits"))


def _with_terms(docs: DataFrame, kept: list[str]) -> DataFrame:
    """(row, base, terms): terms are the spans of the terms to generalise (kind 4) or remove (kind 5)."""
    scanned = _scanned(docs, kept)
    none = F.array().cast(_SPAN)
    found = scanned.join(_revealing(scanned), "uid", "left")

    def places(kind: int, chosen) -> Column:
        hashes = F.transform(F.filter("hits", chosen), lambda h: h["term"])
        return F.when(F.size(hashes) > 0, _places(F.col("masked"), TERM, kind, lambda m: F.array_contains(hashes, _term(m)))).otherwise(none)

    removed, general = places(5, lambda h: h["removed"]), places(4, lambda h: ~h["removed"])
    return found.select("row", "base", F.when(F.col("hits").isNull(), none).otherwise(F.array_sort(F.concat(removed, general))).alias("terms"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)."""
    found = _with_terms(docs.select("doc_id", "text"), ["doc_id"])

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(PATTERNS)]
    return found.select("row.doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(F.array_sort(F.concat("base", "terms"))).alias("spans"))


def sanitised(docs: DataFrame) -> DataFrame:
    """docs -> the same columns; base spans replaced by their kind in brackets, disclosing terms by their class or by nothing."""
    found = _with_terms(docs, docs.columns)
    text, start = F.col("row.text"), F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    mark = F.array(*[F.lit(m) for m in ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "", "")])

    def step(acc: Column, span: Column) -> Column:
        term = F.substring(text, span["start"] + 1, span["end"] - span["start"])
        shape = F.when(term.rlike(r"^\p{Lu}+$"), "[ACRONYM]").when(term.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[TERM]")
        put = F.when(span["kind"] == KINDS.index("term"), shape).otherwise(F.element_at(mark, span["kind"] + 1))
        new = F.concat(acc["out"], F.substring(text, acc["at"] + 1, span["start"] - acc["at"]), put)
        return F.struct(F.greatest(acc["at"], span["end"]).alias("at"), F.when(span["start"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(F.array_sort(F.concat("base", "terms")), start, step)
    clean = F.when((F.size("base") == 0) & (F.size("terms") == 0), text).otherwise(F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    return found.withColumn("clean", clean).select(*[F.col("clean").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
