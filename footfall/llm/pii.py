"""Personal data by patterns, and information-theoretic sanitisation of the
terms around it.  DataFrame functions only.

The patterns find the protected entities: mail addresses, IP addresses, card and
phone numbers.  Terms (words of letters) anywhere in a text that holds an entity
may reveal it.  From co-occurrence over the whole corpus

    PMI(t; e) = log(N n(t, e) / (n(t) n(e)))     IC(e) = log(N / n(e))

with numbers of distinct texts n and N, the share PMI / IC of the entity's
information is what the term discloses.  It is smoothed by 1 - 3^-c, c the number
of different contexts (``CONTEXT`` characters either side of the entity) in the
pair's texts: two are enough for a generalised term, one (and so any number of copies) is not at the default
thresholds.  Terms that disclose at least ``generalise_at`` are generalised, those
of at least ``remove_at`` are removed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.stages import free_name, stage

# The kinds in the order in which spans are listed, and their
# patterns.  Possessive quantifiers and the look-behinds (\G: the end of the last
# match) change no match, they keep the search linear.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
TERM_PATTERN = r"\p{L}{3,40}+"
CONTEXT = 48
_SPAN = "struct<start:int,kind:int,end:int,value:string,before:string,after:string>"
#: Term lists of at most so many 8-byte hashes are broadcast; larger ones are joined by a shuffle.
BROADCAST_TERMS = 500_000


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _valid(kind: str, value: str) -> str:
    """SQL condition on a match."""
    if kind == "ip":
        return f"{value} rlike r'^{IP_PART}(?:\\.{IP_PART}){{3}}$'"
    if kind == "phone":
        return f"length({_digits(value)}) between 10 and 15"
    if kind == "card":
        # Luhn: from the right, every second digit is doubled and its digits added.
        digit = f"cast(substring({_digits(value)}, -j, 1) as int)"
        luhn = (f"aggregate(sequence(1, length({_digits(value)})), 0, (sum, j) -> sum + "
                f"if(j % 2 = 1, {digit}, if({digit} > 4, 2 * {digit} - 9, 2 * {digit})))")
        return f"if(length({_digits(value)}) between 14 and 19, {luhn} % 10 = 0, false)"
    return "true"


def _running(values: str, combine: str) -> str:
    """SQL of the running totals of an array of integers, by doubling: each step combines every
    element with the one 1, 2, 4, ... places before it, so no array is copied for each element."""
    return (f"aggregate(sequence(0, cast(floor(log2(greatest(size({values}), 1))) as int)), {values}, (acc, step) -> "
            f"transform(acc, (x, i) -> if(i < shiftleft(1, step), x, {combine.format('x', 'get(acc, i - shiftleft(1, step))')})))")


def _spans_of(kind: str) -> Column:
    """Valid spans from the arrays of matches and of the texts between them.

    Offsets are running sums of lengths (code points); ``before`` and ``after`` are
    the neighbouring characters without words that the cut splits."""
    k = KINDS.index(kind)
    value, gap, following = "x.value", "x.gap", f"element_at(g_{kind}, i + 2)"
    before = (f"if(length({gap}) > {CONTEXT}, regexp_replace(right({gap}, {CONTEXT}), r'^\\p{{L}}+', ''), {gap})")
    after = (f"if(length({following}) > {CONTEXT}, regexp_replace(left({following}, {CONTEXT}), r'\\p{{L}}+$', ''), "
             f"{following})")
    lengths = f"transform(m_{kind}, (m, i) -> length(m) + length(element_at(g_{kind}, i + 1)))"
    ends = _running(lengths, "{} + {}")
    parts = (f"zip_with(m_{kind}, slice(g_{kind}, 1, size(m_{kind})), "
             f"(m, g) -> named_struct('value', m, 'gap', g))")
    span = (f"named_struct('start', x.to - length({value}), 'kind', {k}, 'end', x.to, 'value', {value}, "
            f"'before', {before}, 'after', {after})")
    placed = f"zip_with({parts}, {ends}, (p, e) -> named_struct('value', p.value, 'gap', p.gap, 'to', e))"
    return F.expr(f"filter(transform({placed}, (x, i) -> if({_valid(kind, value)}, {span}, null)), s -> s is not null)")


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, doc_key, text_key, spans, text`` of every row: leftmost non-overlapping
    matches of each kind, without those that fail their check, by start and kind.

    A null text is an empty one; ``text`` is null in rows without spans.  ``doc_key`` tells documents apart (a hash of id
    and text: repeated rows have the same), ``text_key`` texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("doc_key", F.xxhash64("doc_id", "text")).withColumn("text_key", F.xxhash64("text"))
    none = F.lit(None).cast("array<string>")
    found = rows.select("doc_id", "doc_key", "text_key", "text", *[
        F.when(F.col("text").rlike(p), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none).alias(f"m_{k}")
        for k, p in PATTERNS.items()])
    cut = found.select("doc_id", "doc_key", "text_key", "text", *[f"m_{k}" for k in KINDS], *[
        F.when(F.col(f"m_{k}").isNotNull(), F.split("text", p, -1)).otherwise(none).alias(f"g_{k}")
        for k, p in PATTERNS.items()])
    empty = F.array().cast(f"array<{_SPAN}>")
    spans = F.concat(*[F.when(F.col(f"m_{k}").isNotNull(), _spans_of(k)).otherwise(empty) for k in KINDS])
    return cut.select("doc_id", "doc_key", "text_key", F.array_sort(spans).alias("spans"), "text").withColumn(
        "text", F.when(F.size("spans") > 0, F.col("text")))


def disclosing_terms(docs: DataFrame, occurrences: DataFrame, holding: DataFrame, texts: DataFrame,
                     generalise_at: float = 0.7, text_col: str = "text") -> DataFrame:
    """(entity, t, disclosure) of the pairs whose disclosure reaches the threshold,
    ``t`` the hash of the term.

    ``occurrences``: (entity, text_key, context, n_entity, contexts, n), a row for each
    entity of a text; ``texts``: (text_key, text) of these texts; ``holding``: (text) of all
    rows with a span.  Distinct texts with each candidate term are counted over the whole
    corpus."""
    # PMI / IC is 1 at most and n_pair is n_entity at most, which bounds n(t).
    bound = F.col("n_entity") * F.pow(F.col("n") / F.col("n_entity"),
                                      1 - F.lit(float(generalise_at)) / _evidence("contexts"))
    bounds = occurrences.groupBy("text_key").agg((F.max(bound) * (1 + 1e-9)).alias("bound"))
    words = stage(texts.join(bounds, "text_key").select("text_key", "bound", F.explode(_terms(F.col("text"))).alias("w"))
                  .select("text_key", "bound", F.xxhash64("w").alias("t")), "words")
    near = words.groupBy("t").agg(F.count("*").alias("n_term"), F.max("bound").alias("bound"))
    counts = stage(near.where(F.col("n_term") <= F.col("bound")), "terms")
    # The texts that have a term and one of these entities, then those that have it and any
    # span, are some of all that have it: terms above the bound with these smaller
    # counts are above it with the true one.
    for part, column in ((holding, "text"), (docs, text_col)):
        counted = _texts_with(part, counts.select("t"), column)
        counts = stage(counts.drop("n_term").join(counted, "t").where(F.col("n_term") <= F.col("bound")), "terms")
    kept = words.join(counts.select("t", "n_term"), "t").where(F.col("n_term") <= F.col("bound"))
    pairs = (kept.select("text_key", "t", "n_term").join(occurrences, "text_key").groupBy("entity", "t")
             .agg(F.count("*").alias("n_pair"), F.count_distinct("context").alias("contexts"),
                  F.max("n_term").alias("n_term"), F.max("n_entity").alias("n_entity"), F.max("n").alias("n")))
    share = _evidence("contexts") * (F.log(F.col("n") * F.col("n_pair") / (F.col("n_term") * F.col("n_entity")))
                                     / F.log(F.col("n") / F.col("n_entity")))
    return pairs.withColumn("disclosure", share).where(F.col("disclosure") >= generalise_at).select("entity", "t", "disclosure")


def _evidence(contexts: str) -> Column:
    return 1 - F.pow(F.lit(3.0), -F.col(contexts))


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_key")


def _terms(text: Column) -> Column:
    """Distinct terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM_PATTERN), F.lit(0)), F.lower))


def _places() -> Column:
    """Places of the ``wanted`` terms (a map to ``removed``) in ``text``, in order."""
    words, gaps = f"regexp_extract_all(text, r'{TERM_PATTERN}', 0)", f"split(text, r'{TERM_PATTERN}', -1)"
    ends = _running(f"zip_with({words}, slice({gaps}, 1, size({words})), (w, g) -> length(w) + length(g))", "{} + {}")
    return F.expr(
        f"transform(filter(zip_with({words}, {ends}, (w, e) -> named_struct('w', w, 'to', e)), "
        f"x -> map_contains_key(wanted, lower(x.w))), x -> named_struct('start', x.to - length(x.w), 'end', x.to, "
        f"'removed', element_at(wanted, lower(x.w))))")


def _texts_with(docs: DataFrame, terms: DataFrame, text_col: str) -> DataFrame:
    """(t, n_term): the number of distinct texts with each of the hashed terms."""
    wanted = stage(terms, "terms")
    if wanted.count() <= BROADCAST_TERMS:
        wanted = F.broadcast(wanted)
    words = docs.select(_text_key(text_col), F.explode(_terms(F.col(text_col).cast("string"))).alias("w"))
    return (words.select("text_key", F.xxhash64("w").alias("t")).join(wanted, "t").distinct()
            .groupBy("t").agg(F.count("*").alias("n_term")))


def find_personal_data(docs: DataFrame, generalise_at: float = 0.7, remove_at: float = 0.95,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, doc_key, spans, terms`` of every row of ``docs``.

    ``spans`` are the base spans (start, kind, end, value); ``terms`` all places of
    the text's disclosing terms (start, end, removed), outside all base spans.  A null text is
    an empty one; a row without base spans has no terms; repeated rows each appear;
    a null id stays null; other columns are ignored."""
    base = stage(base_spans(docs, id_col, text_col), "base")
    some = base.where(F.size("spans") > 0)
    each = some.select("text_key", "spans").distinct().select("text_key", F.explode("spans").alias("span")).select(
        "text_key",
        F.xxhash64(F.col("span.kind"), F.when(F.col("span.kind") == 0, F.lower("span.value"))
                   .otherwise(F.expr(_digits("span.value")))).alias("entity"),
        F.xxhash64("span.before", "span.after").alias("context"))
    each = stage(each.groupBy("entity", "text_key").agg(F.min("context").alias("context")), "each")
    total = F.broadcast(base.select("text_key").distinct().agg(F.count("*").alias("n")))
    # Entities with too little evidence, or in every text, have no disclosing term.
    entities = (each.groupBy("entity").agg(F.count("*").alias("n_entity"), F.count_distinct("context").alias("contexts"))
                .join(total).where((_evidence("contexts") >= generalise_at) & (F.col("n_entity") < F.col("n"))))
    occurrences = stage(each.join(entities, "entity"), "occurrences")
    texts = stage(some.select("text_key", "text")
                  .join(occurrences.select("text_key").distinct(), "text_key", "left_semi")
                  .groupBy("text_key").agg(F.min("text").alias("text")), "texts")
    strong = stage(disclosing_terms(docs, occurrences, some.select("text"), texts, generalise_at, text_col), "strong")
    wanted = (texts.select("text_key", F.explode(_terms(F.col("text"))).alias("term"))
              .withColumn("t", F.xxhash64("term")).join(strong.select("t").distinct(), "t")
              .join(occurrences.select("text_key", "entity"), "text_key").join(strong, ["entity", "t"])
              .groupBy("text_key", "term").agg((F.max("disclosure") >= remove_at).alias("removed"))
              .groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("term", "removed"))).alias("wanted")))
    added = texts.join(wanted, "text_key").select("text_key", _places().alias("terms"))
    added = stage(added, "added").withColumnRenamed("text_key", "added_key")
    none = F.array().cast("array<struct<start:int,end:int,removed:boolean>>")
    with_terms = some.join(added, F.col("text_key") == F.col("added_key"), "left").select(
        "doc_id", "doc_key", "spans", F.coalesce(F.expr(
            "filter(terms, t -> not exists(spans, s -> s.start < t.end and t.start < s.end))"), none).alias("terms"))
    without = base.where(F.size("spans") == 0).select("doc_id", "doc_key", "spans", none.alias("terms"))
    return with_terms.union(without)


def listed(spans: str, terms: str | None = None) -> Column:
    """``kind:start:end`` of the spans by start and kind, joined by commas."""
    names = ", ".join(f"'{k}'" for k in (*KINDS, TERM))
    every = f"transform({spans}, s -> named_struct('start', s.start, 'kind', s.kind, 'end', s.end))"
    if terms:
        every = (f"array_sort(concat({every}, transform({terms}, "
                 f"t -> named_struct('start', t.start, 'kind', {len(KINDS)}, 'end', t.end))))")
    return F.expr(f"array_join(transform({every}, x -> concat_ws(':', element_at(array({names}), x.kind + 1), "
                  f"x.start, x.end)), ',')")


def actions(terms: str) -> Column:
    """``generalise`` or ``remove`` with start and end of each term, as in :func:`listed`."""
    return F.expr(f"array_join(transform({terms}, t -> concat_ws(':', if(t.removed, 'remove', 'generalise'), "
                  f"t.start, t.end)), ',')")


def count_of(kind: str) -> Column:
    return F.size(F.expr(f"filter(spans, s -> s.kind = {KINDS.index(kind)})")).cast("long")


def sanitise(docs: DataFrame, generalise_at: float = 0.7, remove_at: float = 0.95,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with entities replaced by their kind in brackets (``[email]``),
    generalised terms by ``[term]`` and removed terms by nothing; overlapping
    spans are replaced together by the mark of the first (then longest), so no part of
    one stays.  Null texts stay null."""
    found = find_personal_data(docs, generalise_at, remove_at, id_col, text_col)
    marks = [F.lit(f"[{k}]") for k in KINDS]
    every = F.array_sort(F.concat(
        F.transform("spans", lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("minus_end"), F.element_at(F.array(*marks), s["kind"] + 1).alias("mark"))),
        F.transform("terms", lambda t: F.struct(
            t["start"].alias("start"), (-t["end"]).alias("minus_end"), F.when(t["removed"], "").otherwise("[term]").alias("mark")))))
    key, cut_key, cut_list = (free_name(docs, n) for n in ("_doc_key", "_cut_key", "_cuts"))
    cuts = stage(found.where(F.size("spans") > 0).select(F.col("doc_key").alias(cut_key), every.alias(cut_list))
                 .dropDuplicates([cut_key]), "cuts")
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col).cast("long"),
                                            F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    joined = keyed.join(cuts, F.col(key) == F.col(cut_key), "left")
    reached = _running(f"transform({cut_list}, c -> -c.minus_end)", "greatest({}, {})")
    # Each cut with the place that it and the cuts before it reach.
    chain = f"zip_with({cut_list}, {reached}, (c, e) -> named_struct('c', c, 'e', e))"
    replaced = F.expr(
        f"aggregate(array({chain}), cast('' as string), (none, cuts) -> concat(array_join(transform(filter("
        f"transform(cuts, (x, i) -> named_struct('c', x.c, 'from', if(i = 0, 0, get(cuts, i - 1).e))), "
        f"y -> y.c.start >= y.from), y -> concat(substring(`{text_col}`, y.from + 1, y.c.start - y.from), y.c.mark)), ''), "
        f"substring(`{text_col}`, element_at(cuts, -1).e + 1, length(`{text_col}`))))")
    text = F.when(F.col(cut_list).isNull(), F.col(text_col)).otherwise(replaced)
    return joined.withColumn(text_col, text).select(*docs.columns)
