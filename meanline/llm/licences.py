"""Licence scan by a positional index of rare words.

Templates are short licence notices.  From each template the index keeps its rarest words (those in the
fewest documents, though in one at least; so of the highest inverse document frequency) with their positions.  The rare words of
a text are looked up; each gives an alignment of a template to the text, and an alignment counts when
half of the template's rare words stand where it says.  A counted alignment is confirmed when the
template's mandatory phrase stands there word by word; its score is the share of all template words in place.

A phrase on its own is a template that is all mandatory, so every place of it is found: its rarest word
stands in every one of them.

Everything here is DataFrame expressions; one pass counts document frequencies of the template words (a
table as small as the templates), one pass scans.  A text's alignments are checked one by one, so the
cost grows with its words.

Defined results
    null or empty text: no words, no labels, score 0, first and last word null.
    a template cut off by the end of the text counts if its rare words and phrase are inside.
    repeated rows and ids: each row is scanned on its own.  Empty table: no rows.  Other columns are kept.
    a document frequency that ties: the alphabetically smaller word is taken.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rare words kept of each template.
KEYS = 4


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: str

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def phrase_at(self) -> tuple[int, int]:
        """First and last position of the mandatory phrase."""
        words, wanted = self.words, self.phrase.split()
        at = next(i for i in range(len(words)) if words[i : i + len(wanted)] == wanted)
        return at, at + len(wanted) - 1


# Phrases that are labels by themselves.
PHRASES = (
    Template("mit", "mit license", "mit license"),
    Template("apache", "apache license", "apache license"),
    Template("gpl", "general public license", "general public license"),
)
# Common licence notices, lower case, without punctuation.
NOTICES = (
    Template("notice-mit", "released under the mit license", "under the mit license"),
    Template(
        "text-mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files", "permission is hereby granted free of charge",
    ),
    Template("notice-apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("notice-gpl", "is licensed under the gnu general public license version", "under the gnu general public license"),
    Template(
        "text-gpl", "it under the terms of the gnu general public license as published by the free software foundation",
        "gnu general public license as published by",
    ),
    Template("notice-lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    Template("notice-cc-by-nc", "licensed under cc by nc", "under cc by nc"),
    Template("notice-cc-by-sa", "licensed under cc by sa", "under cc by sa"),
    Template(
        "text-bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that",
        "redistribution and use in source and binary forms",
    ),
    Template("notice-mpl", "is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: An alignment is one number, template * _APART + _SHIFT + place: numbers are told apart by hashing.
_APART, _SHIFT = 1 << 40, 1 << 20


def words_of(text: str = "text") -> Column:
    """The words of a text, with A-Z lower-cased."""
    parts = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), SEPARATOR)
    return F.filter(parts, lambda w: w != "")


def document_frequencies(documents: DataFrame, templates: tuple[Template, ...]) -> dict[str, int]:
    """In how many documents each template word stands; as many entries as the templates have words."""
    vocabulary = sorted({w for t in templates for w in t.words})
    rows = (
        documents.select(F.explode(F.array_intersect(words_of(), F.array(*map(F.lit, vocabulary)))).alias("word"))
        .groupBy("word").count().collect()
    )
    return dict.fromkeys(vocabulary, 0) | {row["word"]: row["count"] for row in rows}


def rare_positions(template: Template, frequencies: dict[str, int]) -> list[int]:
    """Where the template's rarest words, of those that some document has, stand in it."""
    rarest = sorted((w for w in set(template.words) if frequencies[w]), key=lambda w: (frequencies[w], w))[:KEYS]
    return [i for i, w in enumerate(template.words) if w in rarest]


def scan(documents: DataFrame, phrases: tuple[Template, ...] = PHRASES, notices: tuple[Template, ...] = NOTICES) -> DataFrame:
    """``documents`` with n_words, n_base, first_word, last_word, base_labels, labels and score.

    Base columns are about ``phrases``; ``labels`` also hold the confirmed ``notices``.
    """
    templates = phrases + notices
    frequencies = document_frequencies(documents, templates)
    keys = [rare_positions(t, frequencies) for t in templates]
    numbers = lambda values: F.array(*map(F.lit, values)) if values else F.array().cast("array<int>")
    table = F.array(*(
        F.struct(
            F.lit(t.label).alias("label"), F.lit(i < len(phrases)).alias("base"), numbers(t.words).alias("words"),
            numbers(k).alias("keys"), F.lit(t.phrase_at[0]).alias("from"), F.lit(t.phrase_at[1]).alias("to"),
        )
        for i, (t, k) in enumerate(zip(templates, keys, strict=True))
    ))
    index: dict[str, list[tuple[int, int]]] = {}
    for number, (template, positions) in enumerate(zip(templates, keys, strict=True)):
        for position in positions:
            index.setdefault(template.words[position], []).append((number, position))
    rare = sorted(index)
    postings = F.create_map(*(
        column for word in rare for column in (
            F.lit(word),
            F.array(*(F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in index[word])),
        )
    )).cast("map<string,array<struct<t:int,p:int>>>")
    nothing = F.array().cast("array<bigint>")
    rare_words = F.array(*map(F.lit, rare)).cast("array<string>")
    placed = F.filter(
        F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda s: s["w"].isin(rare)
    )
    alignments = F.array_distinct(F.flatten(F.transform(
        placed,
        lambda s: F.transform(
            F.element_at("_postings", s["w"]), lambda e: e["t"] * F.lit(_APART) + (s["i"] - e["p"] + F.lit(_SHIFT))
        ),
    )))
    stands = lambda at, words, k: F.coalesce(F.get(F.col("_words"), at + k) == F.get(words, k), F.lit(False))

    def judged(alignment: Column) -> Column:
        template = F.get(F.col("_templates"), F.shiftright(alignment, 40).cast("int"))
        at = (F.pmod(alignment, F.lit(_APART)) - F.lit(_SHIFT)).cast("int")
        keys_there = F.size(F.filter(template["keys"], lambda k: stands(at, template["words"], k)))
        phrase_there = F.forall(F.sequence(template["from"], template["to"]), lambda k: stands(at, template["words"], k))
        size = F.size(template["words"])
        share = F.size(F.filter(F.sequence(F.lit(0), size - 1), lambda k: stands(at, template["words"], k))) / size
        confirmed = (2 * keys_there >= F.size(template["keys"])) & phrase_there
        return F.struct(
            template["label"].alias("label"), template["base"].alias("base"), at.cast("bigint").alias("at"),
            F.when(confirmed, share).alias("score"),
        )

    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    others = [c for c in documents.columns if c not in added]
    found = (
        documents.select(F.struct(F.lit(0).alias("held"), *(F.col(f"`{c}`") for c in others)).alias("_row"), words_of().alias("_words"))
        .withColumn("_templates", table).withColumn("_postings", postings)
        .withColumn("_alignments", F.when(F.arrays_overlap("_words", rare_words), alignments).otherwise(nothing))
        .withColumn("_found", F.filter(F.transform("_alignments", judged), lambda f: f["score"].isNotNull()))
        .withColumn("_base", F.filter("_found", lambda f: f["base"]))
    )
    joined = lambda column: F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda f: f["label"]))), ",")
    starts = F.transform("_base", lambda f: f["at"])
    return found.select(
        *(F.col(f"_row.`{c}`") for c in others), F.size("_words").cast("bigint").alias("n_words"), F.size("_base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined("_base").alias("base_labels"), joined("_found").alias("labels"),
        F.coalesce(F.array_max(F.transform("_found", lambda f: f["score"])), F.lit(0.0)).alias("score"),
    )


def scan_sql(phrases: tuple[Template, ...] = PHRASES, notices: tuple[Template, ...] = NOTICES) -> str:
    """The scan of all documents in SQL."""
    rows = ", ".join(
        f"({i}, '{t.label}', {i < len(phrases)}, {t.words!r}, {t.phrase_at[0]}, {t.phrase_at[1]})"
        for i, t in enumerate(phrases + notices)
    )
    return rf"""
with templates(t, label, base, ws, f, l) as (values {rows}),
d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{SEPARATOR}'), lambda w: w <> '') as ws,
  row_number() over () as n from documents),
vocabulary as (select distinct unnest(ws) as w from templates),
frequency as (select v.w, count(x.n) as df from vocabulary v left join
  (select distinct n, w from (select n, unnest(ws) as w from d) where w in (select w from vocabulary)) x on x.w = v.w group by v.w),
distinct_words as (select distinct t, unnest(ws) as w from templates),
rare as (select t, w from (select t, w, row_number() over (partition by t order by df, w) as r
  from distinct_words join frequency using (w) where df > 0) where r <= {KEYS}),
posted as (select t, unnest(ws) as w, unnest(range(len(ws)))::bigint as p from templates),
keys as (select p.t, p.w, p.p from posted p join rare r on p.t = r.t and p.w = r.w),
tokens as (select n, w, i from (select n, unnest(ws) as w, unnest(range(len(ws)))::bigint as i from d) where w in (select w from vocabulary)),
aligned as (select distinct n, t, i - p as place from tokens join keys using (w)),
placed as (select a.n, a.t, a.place, p.p from aligned a join posted p using (t) join tokens k on k.n = a.n and k.i = a.place + p.p and k.w = p.w),
judged as (select n, t, place, count(*) as hits,
    count(*) filter (p in (select k.p from keys k where k.t = placed.t)) as key_hits,
    count(*) filter (p between (select f from templates x where x.t = placed.t) and (select l from templates x where x.t = placed.t)) as phrase_hits
  from placed group by n, t, place),
confirmed as (select j.n, x.label, x.base, j.place, j.hits / len(x.ws)::double as score from judged j join templates x using (t)
  where 2 * key_hits >= (select count(*) from keys k where k.t = j.t) and phrase_hits = x.l - x.f + 1)
select d.doc_id, len(d.ws)::bigint as n_words, count(c.place) filter (c.base) as n_base, min(c.place) filter (c.base) as first_word,
  max(c.place) filter (c.base) as last_word,
  coalesce(string_agg(distinct c.label, ',' order by c.label) filter (c.base), '') as base_labels,
  coalesce(string_agg(distinct c.label, ',' order by c.label), '') as labels, coalesce(max(c.score), 0.0::double) as score
from d left join confirmed c using (n) group by d.n, d.doc_id, d.ws
"""
