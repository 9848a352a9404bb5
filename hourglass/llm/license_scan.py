"""License scans by diagonal voting.

Method. A text's words are its runs of letters and digits, lower-cased. Every
rolling k-gram of words is joined to the positions at which the k-grams of the
license templates stand. A match votes for the diagonal (word position minus
template position) of its template. Neighbouring diagonals (at most ``DRIFT``
apart: a word was put in or left out) are merged into one candidate span. A
span is verified on the words: it stands if enough of the template's k-grams
were found in it, its words and the template's agree to ``AGREE`` as sets, and
so do their pairs of neighbouring words, in order, to ``ORDER``: the same words
in another order are no notice. Verified spans add the template's label.

Base rules find fixed phrases; their labels always stay.

Distribution. The template table is a constant of this module, so its broadcast
is bounded. Votes are summed by (row, template, diagonal) with partial sums;
spans return to the rows they come from, by broadcast if they are few, else by
a shuffle. Nothing leaves the JVM.

Cases. Null and empty text: no word, no label, score 0. Equal rows have equal
results. A null id is kept as null. Texts of any length are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, written

K = 4
DRIFT = 3
COVER = 0.5
AGREE = 0.7
#: An edited word breaks two pairs, so pairs agree less than words.
ORDER = 0.5

#: The phrases of the base rules and their labels.
PHRASES = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))

#: Words of public license notices, by label.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def words(text: Column) -> Column:
    """Words of the text with A-Z lower-cased. The letters whose lower case
    holds an ASCII letter are set aside, so only A-Z can become a-z."""
    t = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("İ"), F.lit("ı")), F.lit("K"), F.lit("ı"))
    return F.filter(F.split(F.lower(t), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), lambda w: w != "")


def _grams(w: str, k: int) -> Column:
    """Hash of the k-gram at each word position of array column ``w``."""
    n = F.size(w) - k
    hashes = F.transform(F.sequence(F.lit(0), n), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
    return F.when(n >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


def template_table(spark, templates=TEMPLATES, k: int = K) -> DataFrame:
    """Rows (template, at, h): each k-gram position of each template."""
    rows = [(i, text.split()) for i, (_, text) in enumerate(templates)]
    df = spark.createDataFrame(rows, "template int, w array<string>")
    return df.select("template", F.posexplode(_grams("w", k)).alias("at", "h"))


def phrase_starts(w: str, phrases=PHRASES) -> list[Column]:
    """For each phrase, the word positions at which it stands."""
    def starts(phrase: tuple[str, ...]) -> Column:
        def fits(i: Column) -> Column:
            cond = F.get(w, i) == phrase[0]
            for j, word in enumerate(phrase[1:], 1):
                cond = cond & (F.get(w, i + j) == word)
            return cond

        at = F.filter(F.sequence(F.lit(0), F.size(w) - 1), fits)
        there = F.array_contains(w, phrase[0]) & F.array_contains(w, phrase[-1])
        return F.when(there, at).otherwise(F.array().cast("array<int>"))

    return [starts(phrase) for phrase, _ in phrases]


def spans(rows: DataFrame, templates=TEMPLATES, k: int = K, drift: int = DRIFT, cover: float = COVER) -> DataFrame:
    """Candidate spans of ``rows`` (id, tag, w): id, tag, template, from, to
    (word positions, ``to`` exclusive) and votes."""
    t = F.broadcast(template_table(rows.sparkSession, templates, k))
    grams = rows.select("id", "tag", F.posexplode(_grams("w", k)).alias("pos", "h"))
    hits = grams.join(t, "h")
    key = ["id", "tag", "template"]
    diagonals = hits.groupBy(*key, (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.collect_set("at").alias("at"), F.min("pos").alias("from"), F.max("pos").alias("to"))
    turn = Window.partitionBy(*key).orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(turn) > drift).cast("int"), F.lit(1))
    merged = diagonals.withColumn("_new", new).withColumn("span", F.sum("_new").over(turn))
    out = merged.groupBy(*key, "span").agg(F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("votes"), F.min("from").alias("from"), (F.max("to") + k).alias("to"))
    grams_of = F.create_map(*[x for i, (_, text) in enumerate(templates) for x in (F.lit(i), F.lit(max(1, len(text.split()) - k + 1)))])
    return out.where(F.col("votes") >= F.lit(cover) * F.element_at(grams_of, F.col("template"))).drop("span")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES, k: int = K, agree: float = AGREE) -> DataFrame:
    """One row a document: id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, and the verified spans (template label, from,
    to, agreement of words, and of pairs in order)."""
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tag"), words(F.col(text)).alias("w"))
    found = written(spans(rows, templates, k), "license-spans")
    lists = found.groupBy(F.col("id").alias("_id"), F.col("tag").alias("_tag")).agg(F.sort_array(F.collect_list(F.struct("template", "from", "to"))).alias("spans"))
    lists = small(written(lists, "license-lists"))
    df = rows.join(lists, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")), "left")
    bags = F.array(*[F.array(*[F.lit(x) for x in sorted(set(t.split()))]) for _, t in templates])
    names = F.array(*[F.lit(label) for label, _ in templates])

    couples = F.array(*[F.array(*[F.lit(x) for x in sorted({f"{a} {b}" for a, b in zip(t.split(), t.split()[1:])})]) for _, t in templates])

    def alike(a: Column, b: Column) -> Column:
        return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))

    def agreement(s: Column) -> Column:
        return alike(F.get(bags, s["template"]), F.slice("w", s["from"] + 1, s["to"] - s["from"]))

    def order(s: Column) -> Column:
        # a span holds k words at least
        pairs = F.transform(F.sequence(s["from"], s["to"] - 2), lambda i: F.concat_ws(" ", F.get("w", i), F.get("w", i + 1)))
        return alike(F.get(couples, s["template"]), pairs)

    checked = F.transform("spans", lambda s: F.struct(F.get(names, s["template"]).alias("label"), s["from"].alias("from"), s["to"].alias("to"), F.round(agreement(s), 6).alias("agreement"), F.round(order(s), 6).alias("order")))
    df = df.withColumn("spans", F.filter(F.coalesce(checked, F.array().cast("array<struct<label:string,from:int,to:int,agreement:double,order:double>>")), lambda s: (s["agreement"] >= agree) & (s["order"] >= ORDER)))
    starts = phrase_starts("w")
    df = df.withColumns({f"_p{i}": s for i, s in enumerate(starts)})
    every = F.concat(*[F.col(f"_p{i}") for i in range(len(starts))])
    base = F.array_distinct(F.filter(F.array(*[F.when(F.size(f"_p{i}") > 0, label) for i, (_, label) in enumerate(PHRASES)]), lambda x: x.isNotNull()))
    df = df.withColumns({"_all": every, "_base": base})
    labels = F.sort_array(F.array_distinct(F.concat("_base", F.transform("spans", lambda s: s["label"]))))
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["agreement"])), F.lit(0.0))
    return df.select(
        F.col("id").alias(doc_id), F.size("w").cast("long").alias("n_words"), F.size("_all").cast("long").alias("n_base"),
        F.array_min("_all").cast("long").alias("first_word"), F.array_max("_all").cast("long").alias("last_word"),
        F.array_join(F.sort_array("_base"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("_base") > 0, F.lit(1.0)).otherwise(best).alias("score"), "spans")
