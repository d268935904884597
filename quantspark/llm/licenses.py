"""Operator 1: licence scan by diagonal voting of word pairs against templates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantspark.llm.common import col, lower_ascii

#: The exact phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Opening words of public licence notices, matched with gaps and changed words.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-notice",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license": "lgpl",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license": "agpl",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "eclipse public license v 2 0": "epl-2.0",
}
#: A word ends at any ASCII character but digits and lower-case letters.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Neighbouring diagonals are at most so many words apart; a notice counts from this share of its word pairs.
MERGE, COVER = 3, 0.75
#: A notice stands within so many times its own length.
STRETCH = 2
#: Stands for the end of a text among the hashes of word pairs.
END = -7_046_029_254_386_353_131


@dataclass(frozen=True)
class Template:
    """Words of a phrase or notice."""

    words: tuple[str, ...]
    label: str
    exact: bool

    @property
    def pairs(self) -> int:
        return len(self.words) - 1


def templates(phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> list[Template]:
    return [Template(tuple(t.split()), label, exact) for d, exact in ((phrases, True), (notices, False)) for t, label in d.items()]


def chain(hits: list[tuple[int, int]], reach: int) -> tuple[int, int]:
    """Length and first text place of the longest chain of (text place, template place) in which both rise, within
    ``reach`` words; the earliest of equal ones."""
    ends: dict[int, tuple[int, int, int]] = {}  # template place: length, -start, last text place
    best = (0, 0)
    for pos, place in sorted(hits, key=lambda h: (h[0], -h[1])):
        before = [(n, s) for q, (n, s, p) in ends.items() if q < place and p < pos and pos + s < reach]
        n, s = max(before, default=(0, -pos))
        if (n + 1, s) > ends.get(place, (0, 0, 0))[:2] or pos + ends[place][1] >= reach:
            ends[place] = (n + 1, s, pos)
        best = max(best, (n + 1, s))
    return best[0], -best[1]


def license_scan(df: DataFrame, known: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: word count, exact phrase places, labels and the best coverage.

    All rolling word pairs of all texts join the templates' pairs by 64-bit hash (the templates are a fixed list, so
    they are broadcast), and both words are compared. A hit votes for the diagonal (place in the text minus place in
    the template); an exact phrase stands where its diagonal has all its votes, whose words are then consecutive. For
    notices, diagonals at most ``MERGE`` words apart merge (insertions and deletions shift the diagonal). A merged span
    with votes enough is verified: it counts if its longest chain of hits in the template's order, within ``STRETCH``
    times the template's length, covers at least ``COVER`` of the template. A last, artificial pair carries each text's
    word count, so that texts without a hit have a row too.

    Null text or no words: 0 words, no places, empty labels, score 0. Null id: a document like any other. Repeated rows
    have one row each. Very long texts: their pairs are rows; the hits of one span are one cell. Ties of coverage: only
    the share is returned. Empty table: no rows. Other columns are not read.
    """
    known = templates() if known is None else known
    spark = df.sparkSession
    grams = [(t, i, *x.words[i : i + 2]) for t, x in enumerate(known) for i in range(x.pairs)]
    table = spark.createDataFrame(grams, "template int, place int, a string, b string")
    table = table.select("template", "place", F.xxhash64("a", "b").alias("hash"), F.struct("a", "b").alias("words")).union(spark.sql(f"SELECT -1, 0, {END}L, NULL"))
    facts = spark.createDataFrame([(t, x.pairs, x.label, x.exact) for t, x in enumerate(known)] + [(-1, 0, "", False)], "template int, pairs int, label string, exact boolean")

    text = F.coalesce(col(text_col), F.lit(""))
    keys = df.select(col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"))
    docs = df.select(col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.split(lower_ascii(text), BREAKS).alias("w"))
    # a break at either end leaves an empty word there
    first, last = (F.element_at("w", 1) == "").cast("int"), ((F.element_at("w", -1) == "") & (F.size("w") > 1)).cast("int")
    pairs = F.transform("w", lambda x, i: F.struct(F.xxhash64(x, F.get("w", i + 1)).alias("hash"), x.alias("a"), F.get("w", i + 1).alias("b")))
    end = F.struct(F.lit(END).cast("long").alias("hash"), F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b"))
    rolled = docs.select("id", "text_hash", first.alias("skip"), (F.size("w") - first - last).alias("n"), F.posexplode(F.array_append(pairs, end)).alias("pos", "pair"))
    rolled = rolled.select("id", "text_hash", "n", (F.col("pos") - F.col("skip")).alias("pos"), "pair.*")
    hits = rolled.join(F.broadcast(table), "hash").filter((F.col("template") < 0) | ((F.col("a") == F.col("words.a")) & (F.col("b") == F.col("words.b"))))

    spans = (
        hits.groupBy("id", "text_hash", "template", F.when(F.col("template") < 0, 0).otherwise(F.col("pos") - F.col("place")).alias("diagonal"))
        .agg(F.collect_set(F.when(F.col("template") >= 0, F.struct("pos", "place"))).alias("hits"), F.max("n").alias("n"))
        .join(F.broadcast(facts), "template")
    )
    by = Window.partitionBy("id", "text_hash", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by)
    spans = spans.withColumn("group", F.when(F.col("exact"), F.col("diagonal")).otherwise(F.sum(F.when(gap <= MERGE, 0).otherwise(1)).over(by)))
    merged = spans.groupBy("id", "text_hash", "template", "group").agg(
        F.max("n").alias("n"), F.first("pairs").alias("pairs"), F.first("label").alias("label"), F.first("exact").alias("exact"), F.flatten(F.collect_list("hits")).alias("hits"), F.min("diagonal").alias("start")
    )
    lengths = [len(x.words) for x in known]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = []
            for t, exact, pairs, hits in zip(*(batch.column(c).to_pylist() for c in ("template", "exact", "pairs", "hits")), strict=True):
                enough = not exact and t >= 0 and len(hits) >= COVER * pairs
                votes.append(chain([(h["pos"], h["place"]) for h in hits], STRETCH * lengths[t])[0] if enough else len(hits))
            keep = [c for c in batch.schema.names if c != "hits"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(votes, pa.int64())], names=[*keep, "votes"])

    plain = [f for f in merged.schema if f.name != "hits"]
    verified = merged.select(*(f.name for f in plain), "hits").mapInArrow(verify, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in plain)}, votes long")
    cover = F.when(F.col("template") < 0, 0.0).otherwise(F.col("votes") / F.col("pairs"))
    place = F.col("exact") & (F.col("votes") == F.col("pairs"))
    is_label = place | (~F.col("exact") & (F.col("template") >= 0) & (cover >= COVER))
    out = verified.groupBy("id", "text_hash").agg(
        F.max(F.when(F.col("template") < 0, F.col("n"))).cast("long").alias("n_words"),
        F.count_if(place).alias("n_base"),
        F.min(F.when(place, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(place, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(is_label, F.col("label")))), ",").alias("labels"),
        F.max(cover).alias("score"),
    )
    # as many rows as came in
    same = keys["text_hash"].eqNullSafe(out["text_hash"]) & keys["id"].eqNullSafe(out["id"])
    return keys.join(out, same).drop(out["id"], out["text_hash"]).withColumnRenamed("id", id_col)


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Query: all whole documents."""
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_hash")
