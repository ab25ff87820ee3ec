"""License scans: an exact set-similarity join of text blocks with license templates.

Words are runs of letters and digits. The distinct words of a template are ordered by how often they occur in the whole
corpus, rarest first. A block that holds at least ``threshold`` of a template's words must hold one of its first
``size - needed + 1`` words (prefix filter), must have ``needed`` distinct words (length filter), and where the first
common word stands in that order bounds what can still follow (positional filter). What passes is counted exactly.

Blocks of a template of L words are all runs of 2 L words that start at a multiple of L, so every run of up to L words
lies in one whole. Fixed phrases are counted beside it. Texts never leave their task; the corpus sends back one count
per template word and task.

Defined results: a null or empty text has no words, no labels and score 0. Repeated rows are judged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edilake.llm import tokens

# fixed values: phrases that give a label wherever they stand
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

# fixed values: opening words of public license notices
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


class Plan:
    """Templates and phrases as word hashes, with the corpus-wide order of template words."""

    def __init__(self, templates, phrases, counts: dict[int, int], threshold: float):
        self.labels, self.lengths, self.sets, self.needed, prefixes = [], [], [], [], []
        hashes = {w: int(tokens.hash_word(w)) for _, t in templates for w in t.split()}
        order = sorted(hashes.values(), key=lambda h: (counts.get(h, 0), h))
        self.vocabulary = np.array(sorted(order), np.uint64)
        # rank of each vocabulary entry in the global order
        place = {h: i for i, h in enumerate(order)}
        self.rank = np.array([place[int(h)] for h in self.vocabulary])
        for label, text in templates:
            words = text.split()
            ranks = sorted({place[hashes[w]] for w in words})
            needed = int(np.ceil(round(threshold * len(ranks), 9)))
            self.labels.append(label)
            self.lengths.append(len(words))
            self.sets.append(np.array(ranks))
            self.needed.append(needed)
            prefixes.append(set(ranks[:len(ranks) - needed + 1]))
        self.holders = [[i for i, p in enumerate(prefixes) if r in p] for r in range(len(order))]
        self.leading = np.array([bool(h) for h in self.holders])
        self.phrases = [(np.array([tokens.hash_word(w) for w in p.split()], np.uint64), label) for p, label in phrases]

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """Global rank of each word, -1 if it is in no template."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, self.rank[at], -1)

    def search(self, hashes: np.ndarray) -> list[tuple[int, int, float]]:
        """(template, start word, containment) of all blocks that meet the threshold."""
        ranks = self.ranks(hashes)
        places = np.flatnonzero(ranks >= 0)
        places = places[self.leading[ranks[places]]]
        seen, out = set(), []
        for at in places.tolist():
            for i in self.holders[ranks[at]]:
                length = self.lengths[i]
                for block in (at // length - 1, at // length):
                    if block < 0 or (i, block) in seen:
                        continue
                    seen.add((i, block))
                    share = self.contained(i, ranks[block * length:(block + 2) * length], hashes[block * length:(block + 2) * length])
                    if share:
                        out.append((i, block * length, share))
        return out

    def contained(self, i: int, ranks: np.ndarray, hashes: np.ndarray) -> float:
        template, needed = self.sets[i], self.needed[i]
        if len(hashes) < needed:
            return 0.0
        block = np.unique(ranks[ranks >= 0])
        common = np.isin(template, block, assume_unique=True)
        first = int(common.argmax())
        if len(template) - first < needed or len(block) - int(np.searchsorted(block, template[first])) < needed:
            return 0.0  # too little is left after the first common word
        n = int(common.sum())
        return n / len(template) if n >= needed else 0.0


def word_counts(docs: DataFrame, templates, text: str = "text") -> dict[int, int]:
    """Occurrences of each template word in all texts; as many rows as the templates have words."""
    vocabulary = np.unique(np.array([tokens.hash_word(w) for _, t in templates for w in t.split()], np.uint64))

    def run(batches):
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for group in tokens.chunks(tokens.text_column(batch, text), len):
                h, _ = tokens.word_hashes(group, tokens.ALNUM)
                at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                total += np.bincount(at[vocabulary[at] == h], minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vocabulary))), pa.array(total)], ["word", "n"])

    rows = docs.select(text).mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {int(vocabulary[r["word"]]): r["n"] for r in rows}


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and blocks: the label, first word
    and containment of every text block that meets the threshold."""
    plan = Plan(templates, phrases, word_counts(docs, templates), threshold)
    fields = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
              "score double, blocks array<struct<label:string,word:bigint,containment:double>>")

    def judge(h):
        places, base = [], set()
        for phrase, label in plan.phrases:
            k = len(phrase)
            hit = np.flatnonzero(np.logical_and.reduce([h[j:max(0, len(h) - k + 1) + j] == phrase[j] for j in range(k)]))
            if len(hit):
                base.add(label)
                places.append(hit)
        found = plan.search(h)
        at = np.concatenate(places) if places else None
        labels = base | {plan.labels[i] for i, _, _ in found}
        return {"n_words": len(h), "n_base": 0 if at is None else len(at),
                "first_word": None if at is None else int(at.min()), "last_word": None if at is None else int(at.max()),
                "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)),
                "score": 1.0 if base else max((s for _, _, s in found), default=0.0),
                "blocks": [{"label": plan.labels[i], "word": w, "containment": s} for i, w, s in sorted(found)]}

    kept = docs.select("doc_id", "text")
    id_type = kept.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([(n, t) for n, t in (("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
                        ("score", pa.float64()), ("blocks", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("containment", pa.float64())]))))])

    def run(batches):
        for batch in batches:
            rows = []
            for group in tokens.chunks(tokens.text_column(batch), len):
                h, bounds = tokens.word_hashes(group, tokens.ALNUM)
                rows.extend(judge(h[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True))
            out = pa.RecordBatch.from_pylist(rows, schema)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *out.columns], ["doc_id", *schema.names])

    return kept.mapInArrow(run, f"doc_id {id_type}, {fields}")
