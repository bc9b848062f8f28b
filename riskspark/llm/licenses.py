"""License scans with a positional rare-token index.

The templates below are short notices and characteristic sentences of common licences. The index
maps each template word to its (template, position) postings. A first pass counts, over all
documents, in how many each template word occurs; that gives the IDF of every licence word. In the
second pass a document sorts the licence words it holds by falling IDF and looks up, for each template, the ``RARE``
first ones that the template holds too: which words these are differs from file to file, so a notice with its rarest
words altered is found by the next ones. Their postings are intersected by relative position (document position - template
position, each word once, weighted by IDF), and a template is accepted when the alignment carries at least ``MIN_SHARE``
of the weight of the template's own ``RARE`` rarest words and each mandatory key phrase stands at its aligned place, give or take
``SLACK`` words. Labels of the four base phrases are exact matches and always stay.

The index is a constant of the module and grows with the number of templates only; the collected
document frequencies have one row per template word.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows give
repeated equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import map_texts, words_of

# Base phrases (lower-case words) and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Label, notice or characteristic sentence, mandatory key phrases.
TEMPLATES = [
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.",
     ["gnu general public license", "version 3"]),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2.",
     ["gnu general public license", "version 2"]),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License",
     ["gnu general public license", "free software foundation", "version 3"]),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation; either version 2 of the License",
     ["gnu general public license", "free software foundation", "version 2"]),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License as published by the Free Software Foundation", ["gnu lesser general public license"]),
    ("agpl-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software "
     "Foundation, either version 3 of the License", ["gnu affero general public license"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0.", ["apache license", "version 2 0"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
     "in compliance with the License.", ["apache license", "version 2 0", "compliance with the license"]),
    ("mit", "Released under the MIT License.", ["mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files", ["permission is hereby granted", "free of charge", "associated documentation files"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted", ["permission to use copy modify", "with or without fee is hereby granted"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
     ["mozilla public license"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0.", ["cc by nc", "4 0"]),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0.", ["cc by sa", "4 0"]),
    ("cc-by-4.0", "Licensed under CC BY 4.0.", ["cc by 4 0"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution International License",
     ["creative commons attribution"]),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
     "this work CC0", ["waived all copyright and related or neighboring rights"]),
    ("unlicense", "This is free and unencumbered software released into the public domain.",
     ["free and unencumbered software released into the public domain"]),
]
RARE = 8
MIN_SHARE = 0.6
SLACK = 2


class Index:
    """Postings, weights and key phrases of the templates."""

    def __init__(self, templates=None, idf: dict[bytes, float] | None = None, rare: int = RARE):
        templates = TEMPLATES if templates is None else templates
        self.labels = [label for label, _, _ in templates]
        self.words = [words_of(text.encode()) for _, text, _ in templates]
        self.phrases = []
        for words, (_, _, phrases) in zip(self.words, templates):
            places = []
            for p in phrases:
                key = words_of(p.encode())
                at = [q for q in range(len(words)) if words[q:q + len(key)] == key]
                if not at:
                    raise ValueError(f"key phrase {p!r} isn't in its template")
                places.append((at[0], key))
            self.phrases.append(places)
        self.vocabulary = {w for words in self.words for w in words}
        self.idf = idf or {}
        self.rare = rare
        self.order = {w: k for k, w in enumerate(sorted(self.vocabulary, key=lambda w: (-self.weight(w), w)))}
        # no file's words can weigh more in a template than its own rarest ones
        self.most = [sum(self.weight(w) for w in sorted(set(words), key=self.order.get)[:rare]) for words in self.words]
        self.holders: dict[bytes, list[int]] = {}
        for t, words in enumerate(self.words):
            for w in set(words):
                self.holders.setdefault(w, []).append(t)
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            for q, w in enumerate(words):
                self.postings.setdefault(w, []).append((t, q))

    def weight(self, word: bytes) -> float:
        return self.idf.get(word, 0.0)

    def find(self, words: list[bytes], min_share: float = MIN_SHARE, slack: int = SLACK) -> list[tuple[str, float, int]]:
        """(label, share, document position) of the best accepted alignment of each label."""
        looked: dict[int, set[bytes]] = {}
        for w in sorted(self.vocabulary.intersection(words), key=self.order.get):
            for t in self.holders[w]:
                if len(looked.setdefault(t, set())) < self.rare:
                    looked[t].add(w)
        # no alignment can carry more than the weight of all looked-up words
        wanted = {t: top for t, top in looked.items() if self.most[t] and sum(map(self.weight, top)) >= min_share * self.most[t]}
        if not wanted:
            return []
        rare = set().union(*wanted.values())
        votes: dict[tuple[int, int], set[bytes]] = {}
        for p, w in enumerate(words):
            if w in rare:
                for t, q in self.postings[w]:
                    if w in wanted.get(t, ()):
                        votes.setdefault((t, p - q), set()).add(w)
        best: dict[str, tuple[float, int]] = {}
        for (t, shift), aligned in votes.items():
            share = min(1.0, sum(self.weight(w) for w in sorted(aligned)) / self.most[t])
            if share < min_share or share <= best.get(self.labels[t], (0.0, 0))[0]:
                continue
            if all(any(words[a:a + len(key)] == key for a in range(max(0, shift + q - slack), max(0, shift + q + slack + 1)))
                   for q, key in self.phrases[t]):
                best[self.labels[t]] = (share, max(0, shift))
        return sorted((label, s, p) for label, (s, p) in best.items())


def document_frequencies(docs: DataFrame, text: str = "text", templates=None) -> tuple[dict[bytes, int], int]:
    """In how many documents each template word occurs, and the number of documents."""
    def make():
        vocabulary = Index(templates).vocabulary

        def run(texts):
            return {"seen": [[w.decode() for w in vocabulary.intersection(words_of(t))] for t in texts]}
        return run

    seen = map_texts(docs, make, [T.StructField("seen", T.ArrayType(T.StringType()))], text, [])
    rows = seen.select(F.explode(F.concat("seen", F.array(F.lit("")))).alias("w")).groupBy("w").count().collect()
    df = {r["w"].encode(): int(r["count"]) for r in rows}
    return df, df.pop(b"", 0)


def scan(docs: DataFrame, keep=("doc_id",), text: str = "text", templates=None, rare: int = RARE,
         min_share: float = MIN_SHARE, slack: int = SLACK) -> DataFrame:
    """``keep`` plus n_words, n_base, first_word, last_word, base_labels, labels (sorted arrays),
    score and spans (label, share, word) of the accepted templates."""
    df, n = document_frequencies(docs, text, templates)
    idf = {w: math.log((n + 1) / (c + 1)) + 1.0 for w, c in df.items()}
    idf |= {w: math.log(n + 1) + 1.0 for w in Index(templates).vocabulary if w not in idf}
    found = T.StructType([T.StructField("label", T.StringType()), T.StructField("share", T.DoubleType()),
                          T.StructField("word", T.LongType())])
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
              T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
              T.StructField("base_labels", T.ArrayType(T.StringType())), T.StructField("labels", T.ArrayType(T.StringType())),
              T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(found))]

    def make():
        index = Index(templates, idf, rare)
        base = [(words_of(p.encode()), label) for p, label in BASE.items()]

        def run(texts):
            out = {f.name: [] for f in fields}
            for t in texts:
                words = words_of(t)
                joined = b" " + b" ".join(words) + b" "
                places, labels = [], set()
                for phrase, label in base:
                    needle = b" " + b" ".join(phrase) + b" "
                    if needle in joined:
                        labels.add(label)
                        at = words.index(phrase[0])
                        while at >= 0:
                            if words[at:at + len(phrase)] == phrase:
                                places.append(at)
                            try:
                                at = words.index(phrase[0], at + 1)
                            except ValueError:
                                at = -1
                spans = index.find(words, min_share, slack)
                out["n_words"].append(len(words))
                out["n_base"].append(len(places))
                out["first_word"].append(min(places, default=None))
                out["last_word"].append(max(places, default=None))
                out["base_labels"].append(sorted(labels))
                out["labels"].append(sorted(labels | {s[0] for s in spans}))
                out["score"].append(1.0 if labels else max((s[1] for s in spans), default=0.0))
                out["spans"].append([{"label": a, "share": b, "word": c} for a, b, c in spans])
            return out
        return run

    return map_texts(docs, make, fields, text, keep)
