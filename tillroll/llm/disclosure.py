"""Personal data: patterns, and terms that disclose what they stand beside.

The base patterns find mail and IP addresses, payment cards and phone numbers.
Each distinct value is a protected entity.  Over all documents, the words in
the windows around an entity's mentions are counted, and so are the documents
that hold each of these words anywhere.  The pointwise mutual information of a
word and an entity, as a share of the entity's information content, is how much
of the entity the word gives away:

    disclosure = PMI(word; entity) / IC(entity) = 1 - log(df(word) / n(word, entity)) / log(N / n(entity))

Words at or over the threshold, seen in enough different windows, are removed
from the documents that mention the entity.  Only Spark expressions are used.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut
from .quality import let

#: Base patterns.  Possessive quantifiers take what greedy ones would and never go back; \G or a look-behind lets a match
#: start only where the leftmost one can, so a long run of letters or digits is read once.  A card has 16 digits at least.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
KINDS = tuple(PATTERNS)
TERM = r"\p{L}{3,}+"

#: Characters on each side of a mention, different windows that must agree, and the share of an entity's information.
WINDOW, SUPPORT, THRESHOLD = 80, 3, 0.9
#: Tables of up to this many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 20_000
#: Texts with equal keys go to this many tasks where they are joined by a shuffle.
SALTS = 64
#: Elements of a list that a step copies while it grows; and spans that are cut from one piece of text.
GROWTH, PIECE = 32, 256


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's check of a string of at most 19 digits."""
    n = F.length(digits)

    def weighed(i: Column) -> Column:
        d = F.ascii(F.substring(digits, n - i, F.lit(1))) - 48
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), weighed), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _parted(text: Column, pattern: str | Column, body: Callable[[Column, Column], Column]) -> Column:
    """``body(matches, pieces)``: the matches of a pattern, and the text before, between and after them."""
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    both = F.struct(F.regexp_extract_all(text, p, F.lit(0)).alias("m"), F.split(text, p, F.lit(-1)).alias("p"))
    return let(both, lambda s: body(s["m"], s["p"]))


def gathered(items: Column, zero: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Struct (state, list) of a fold whose ``step(state, item)`` gives the next state and an array to append (of ``kind``).

    The list grows in pieces, so a step copies at most a piece, not all that was gathered before.
    """
    none, no_piece = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def next_(acc: Column, item: Column) -> Column:
        state, new = step(acc["state"], item)
        full = F.size(acc["open"]) >= GROWTH
        return F.struct(state.alias("state"), F.concat(F.when(full, none).otherwise(acc["open"]), new).alias("open"),
                        F.when(full, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]).alias("done"))

    return F.aggregate(items, F.struct(zero.alias("state"), none.alias("open"), no_piece.alias("done")), next_, lambda acc: F.struct(
        acc["state"].alias("state"), F.flatten(F.concat(acc["done"], F.array(acc["open"]))).alias("list")))


SPANS = "array<struct<start:bigint,end:bigint,value:string,left:string,right:string>>"


def find(text: Column, pattern: str | Column, test: Callable[[Column], Column], window: int = 0) -> Column:
    """Matches that pass ``test`` as (start, end, value, left, right): code points, end exclusive, and the text around."""

    def spans(m: Column, p: Column) -> Column:
        def step(acc: Column, value: Column) -> tuple[Column, Column]:
            start = acc["at"] + F.length(F.get(p, acc["i"]))
            return F.struct((acc["i"] + 1).alias("i"), (start + F.length(value)).alias("at")), F.array(start)

        starts = gathered(m, F.struct(F.lit(0).alias("i"), F.lit(0).cast("long").alias("at")), "bigint", step)["list"]
        side = (lambda c, at: F.substring(c, at, window)) if window else (lambda c, at: F.lit(""))
        return let(starts, lambda st: F.filter(F.transform(m, lambda v, i: F.struct(
            F.get(st, i).alias("start"), (F.get(st, i) + F.length(v)).alias("end"), v.alias("value"),
            side(F.get(p, i), -window).alias("left"), side(F.get(p, i + 1), 1).alias("right"))),
            lambda s: test(s["value"])))

    return F.when(text.rlike(pattern) if isinstance(pattern, str) else F.lit(True),
                  _parted(text, pattern, spans)).otherwise(F.array().cast(SPANS))


def base_spans(text: Column, kind: str, window: int = 0) -> Column:
    spans = find(text, PATTERNS[kind], lambda v: valid(kind, v), window)
    hint = HINTS[kind]
    return F.when(text.contains(hint), spans).otherwise(F.array().cast(SPANS)) if hint else spans


def entity(kind: str, value: Column) -> Column:
    """The protected value: case and punctuation do not tell values apart."""
    return F.concat(F.lit(kind + ":"), F.lower(value) if kind in ("email", "ip") else _digits(value))


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _window_terms(s: Column, window: int) -> Column:
    """Words of both sides of a mention, without those that the window's border cuts."""
    left = F.when(F.length(s["left"]) < window, s["left"]).otherwise(F.regexp_replace(s["left"], r"^\p{L}+", ""))
    right = F.when(F.length(s["right"]) < window, s["right"]).otherwise(F.regexp_replace(s["right"], r"\p{L}+$", ""))
    return F.array_distinct(F.concat(_terms(left), _terms(right)))


def text_key(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def disclosing_terms(docs: DataFrame, text: str = "text", window: int = WINDOW, support: int = SUPPORT,
                     threshold: float = THRESHOLD) -> DataFrame:
    """(key, terms): per text (md5) that mentions a protected entity, the sorted words that disclose one of its entities.

    All documents count.  A copy of a text adds to the document counts of a word and
    of an entity alike, but not to the number of different windows.
    """
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"))

    def of_kind(kind: str) -> Column:
        return F.transform(base_spans(F.col("t"), kind, window), lambda s: F.struct(
            entity(kind, s["value"]).alias("entity"), F.xxhash64(s["left"], s["right"]).alias("window"),
            _window_terms(s, window).alias("terms")))

    mentions = F.concat(*[of_kind(k) for k in KINDS])
    hit = cut(rows.select("t", mentions.alias("m")).where(F.size("m") > 0).select(text_key(F.col("t")).alias("key"), "m")
              .groupBy("key").agg(F.count("*").alias("copies"), F.first("m").alias("m")), "mentions", True)
    n_docs = docs.count()

    def told(documents: str) -> Column:
        more = F.greatest(F.lit(1.0), F.col(documents) / F.col("n_joint"))
        return 1 - F.log(more) / F.nullif(F.log(F.lit(float(n_docs)) / F.col("n_entity")), F.lit(0.0))

    flat = hit.select("key", "copies", F.explode("m").alias("m")).select("key", "copies", "m.*")
    # documents of each entity; (entity, word): documents, and different windows
    of_entity = flat.select("key", "copies", "entity").distinct().groupBy("entity").agg(F.sum("copies").alias("n_entity"))
    words = flat.select("key", "copies", "entity", "window", F.explode("terms").alias("term"))
    seen = words.groupBy("entity", "term").agg(F.min("window").alias("lo"), F.max("window").alias("hi"))
    several = words.join(seen.where("lo <> hi").select("entity", "term"), ["entity", "term"], "left_semi")
    windows = several.select("entity", "term", "window").distinct().groupBy("entity", "term") \
        .agg(F.count("*").alias("windows")).where(F.col("windows") >= support)
    joint = several.select("key", "copies", "entity", "term").distinct().groupBy("entity", "term") \
        .agg(F.sum("copies").alias("n_joint"))
    # the documents of a word are at least those that have it in some window: most words are out without reading the corpus
    near = words.select("key", "copies", "term").distinct().groupBy("term").agg(F.sum("copies").alias("n_near"))
    pairs = windows.join(joint, ["entity", "term"]).join(of_entity, "entity").join(near, "term")
    pairs = cut(pairs.where((F.col("n_entity") < n_docs) & (told("n_near") >= threshold)), "term-entity", True)
    wanted = pairs.select("term").distinct()
    if pairs.isEmpty():
        return hit.select("key", F.array().cast("array<string>").alias("terms")).limit(0)
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    df = rows.select(F.explode(F.array_distinct(_terms(F.col("t")))).alias("term")).join(wanted, "term", "left_semi") \
        .groupBy("term").agg(F.count("*").alias("df"))
    flagged = pairs.join(df, "term").where(told("df") >= threshold).select("entity", "term")
    return flat.select("key", "entity").distinct().join(flagged, "entity").groupBy("key") \
        .agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _with_terms(docs: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """``docs`` as (doc, t, terms): each row with the words to remove from it (null: none)."""
    terms = cut(terms, "disclosing-terms", True)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.coalesce(F.col(text), F.lit("")).alias("t"))
    n = terms.count()
    if not n:
        return rows.withColumn("terms", F.lit(None).cast("array<string>"))
    keyed = rows.withColumn("key", text_key(F.col("t")))
    if n <= BROADCAST_ROWS:
        return keyed.join(F.broadcast(terms), "key", "left").select("doc", "t", "terms")
    # only a text that mentions an entity can have terms: the others stay where they are
    mentions = F.coalesce(reduce(Column.__or__, [F.size(base_spans(F.col("t"), k)) > 0 for k in KINDS]), F.lit(False))
    spread = terms.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    some = keyed.where(mentions).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    return some.join(spread, ["key", "salt"], "left").select("doc", "t", "terms") \
        .unionByName(rows.where(~mentions).withColumn("terms", F.lit(None).cast("array<string>")))


def _term_pattern(terms: Column) -> Column:
    return F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(terms, "|"), F.lit(r")(?!\p{L})"))


def _listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat(F.lit(kind + ":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term.

    Null texts are empty.  Rows are independent once the disclosing words are known;
    repeated rows stay, other columns are not read.  Words inside a base match are
    not listed again.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = _with_terms(rows, "text", disclosing_terms(rows, **options))
    t = F.col("t")
    found = rows.select(F.col("doc.doc_id").alias("doc_id"), "t", "terms",
                        F.struct(*[base_spans(t, k).alias(k) for k in KINDS]).alias("base"))
    every = F.concat(*[F.col(f"base.{k}") for k in KINDS])
    terms = find(t, _term_pattern(F.col("terms")), lambda v: F.lit(True))
    term = F.when(F.size("terms") > 0, _outside(terms, every)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))
    found = found.select("doc_id", "base", term.alias("term"))
    base = F.concat(*[_listed(k, F.col(f"base.{k}")) for k in KINDS])
    listed = found.select("doc_id", "base", "term", F.array_join(base, ",").alias("listed"),
                          F.array_join(F.concat(base, _listed("term", F.col("term"))), ",").alias("spans"))
    return listed.select("doc_id", *[F.size(f"base.{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                         F.sha2(F.col("listed").cast("binary"), 256).alias("base_sha256"), "spans",
                         F.size("term").cast("long").alias("n_term"))


def _replaced(text: Column, pattern: str | Column, test: Callable[[Column], Column], by: str) -> Column:
    def joined(m: Column, p: Column) -> Column:
        new = F.transform(m, lambda v: F.when(test(v), F.lit(by)).otherwise(v))
        return F.array_join(F.zip_with(p, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return _parted(text, pattern, joined)


def _merged(spans: Column) -> Column:
    """Spans (start, end, size, label) by start, overlapping ones as one: its label is that of the longest."""
    kind = "struct<start:bigint,end:bigint,size:bigint,label:string>"

    def step(last: Column, s: Column) -> tuple[Column, Column]:
        both = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
                        F.greatest(last["size"], s["size"]).alias("size"),
                        F.when(s["size"] > last["size"], s["label"]).otherwise(last["label"]).alias("label"))
        overlap = last["end"] > s["start"]
        return (F.when(overlap, both).otherwise(s).cast(kind),
                F.when(last.isNull() | overlap, F.array().cast(f"array<{kind}>")).otherwise(F.array(last)))

    ordered = F.sort_array(spans).cast(f"array<{kind}>")
    return let(gathered(ordered, F.lit(None).cast(kind), kind, step), lambda g: F.concat(g["list"], F.array(g["state"])))


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with each of the merged spans as its label, in one pass."""
    def body(m: Column) -> Column:
        def stretch(c: Column) -> Column:
            """Up to ``PIECE`` spans from place ``c`` on, and the text from the span before to the last of them."""
            begin = F.when(c > 0, F.get(m, c - 1)["end"]).otherwise(F.lit(0).cast("long"))
            stop = F.get(m, F.least(c + PIECE, F.size(m)) - 1)["end"]
            return let(F.struct(begin.alias("begin"), F.slice(m, c + 1, F.lit(PIECE)).alias("m"),
                                F.substring(text, (begin + 1).cast("int"), (stop - begin).cast("int")).alias("t")), masked)

        def masked(x: Column) -> Column:
            def piece(s: Column, i: Column) -> Column:
                before = F.when(i > 0, F.get(x["m"], i - 1)["end"]).otherwise(x["begin"])
                return F.concat(F.substring(x["t"], (before - x["begin"] + 1).cast("int"), (s["start"] - before).cast("int")),
                                F.lit("["), s["label"], F.lit("]"))
            return F.array_join(F.transform(x["m"], piece), "")

        rest = F.get(m, F.size(m) - 1)["end"]
        stretches = F.transform(F.sequence(F.lit(0), F.size(m) - 1, F.lit(PIECE)), stretch)
        return F.concat(F.array_join(stretches, ""), F.substring(text, (rest + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, let(_merged(spans), body)).otherwise(text)


def _outside(terms: Column, base: Column) -> Column:
    """(start, end) of the terms that overlap no base span, from one pass over both by start."""
    kind = "struct<start:bigint,end:bigint>"
    span = lambda of, is_base: F.transform(of, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(is_base).alias("base")))
    none = F.array().cast(f"array<{kind}>")

    def step(acc: Column, s: Column) -> tuple[Column, Column]:
        """State: how far the base spans reach, and the last term, unless a base span overlaps it."""
        term, held = acc["term"], F.struct(s["start"].alias("start"), s["end"].alias("end")).cast(kind)
        state = F.struct(
            F.when(s["base"], F.greatest(acc["reach"], s["end"])).otherwise(acc["reach"]).alias("reach"),
            F.when(s["base"], F.when(s["start"] >= term["end"], term)).when(s["start"] >= acc["reach"], held).alias("term"))
        return state, F.when(s["base"] | term.isNull(), none).otherwise(F.array(term))

    zero = F.struct(F.lit(0).cast("long").alias("reach"), F.lit(None).cast(kind).alias("term"))
    return let(gathered(F.sort_array(F.concat(span(terms, False), span(base, True))), zero, kind, step),
               lambda g: F.concat(g["list"], F.when(g["state"]["term"].isNull(), none).otherwise(F.array(g["state"]["term"]))))


def sanitise(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with personal data generalised in ``text``; all other columns as they were.

    Matches become [EMAIL], [IP], [CARD] and [PHONE], disclosing words [TERM].  All
    are found in the text as it was, and overlapping ones become one; what is a valid
    match only once its neighbours are gone is masked after that.  Null texts stay
    null, clean texts stay as they are.
    """
    rows = _with_terms(docs, text, disclosing_terms(docs, text, **options))
    t = F.col("t")

    def of(spans: Column, label: str) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                     (s["end"] - s["start"]).alias("size"), F.lit(label).alias("label")))

    term = F.when(F.size("terms") > 0, find(t, _term_pattern(F.col("terms")), lambda v: F.lit(True))) \
        .otherwise(F.array().cast(SPANS))
    out = rows.select("doc", "t", F.concat(*[of(base_spans(t, k), k.upper()) for k in KINDS], of(term, "TERM")).alias("spans"))
    out = out.select("doc", _masked(t, F.col("spans")).alias("t"), (F.size("spans") > 0).alias("changed"))
    for k in KINDS:
        new = _replaced(t, PATTERNS[k], lambda v, k=k: valid(k, v), f"[{k.upper()}]")
        some = t.rlike(PATTERNS[k])
        if HINTS[k]:
            some = t.contains(HINTS[k]) & some
        out = out.withColumn("t", F.when(F.col("changed") & some, new).otherwise(t))
    return out.select(*[F.when(F.col("doc")[c].isNotNull(), F.col("t")).alias(c) if c == text else F.col("doc")[c].alias(c)
                        for c in docs.columns])
