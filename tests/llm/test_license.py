import math
import re

from tallyforge.llm import license
from tallyforge.llm.queries import QUERIES

from .conftest import rows_of_edge

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(text):
    lower = (text or "").translate(ASCII)
    words = re.findall(WORD, lower)
    places = sorted((label, i) for phrase, label in license.PHRASES.items() for i in range(len(words))
                    if words[i:i + len(phrase.split())] == phrase.split())
    matches = {}
    for block in re.sub(r"([.!?])[ \t\r]+", "\\1\n", lower).split("\n"):
        have = set(re.findall(WORD, block))
        for label, template in license.TEMPLATES.items():
            wanted = set(license.template_words(template))
            if len(wanted & have) >= math.ceil(license.THRESHOLD * len(wanted) - 1e-9):
                matches[label] = max(matches.get(label, 0), len(wanted & have) / len(wanted))
    return len(words), places, sorted(matches.items())


def got(df):
    return sorted(((r.doc_id, r.n_words, sorted((p.label, p.start) for p in r.places), [(m.label, m.score) for m in r.matches])
                   for r in license.scan_licenses(df).collect()), key=repr)


def want(rows):
    return sorted(((i, *brute(t)) for i, t in rows), key=repr)


def test_phrases_and_templates(frame):
    texts = [
        "Licensed under the Apache License, Version 2.0.", "licensed under apache license 2 0 and more words", "CC BY cc-by CC, BY",
        "All rights reserved all rights reserved", "all rights\nreserved", "mit der Zeit", "Released under MIT License!",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "", None, "a general public license b",
        "general general public license license", "Ünder the MIT license released", "under the license",
    ]
    assert got(frame(texts)) == want(list(enumerate(texts)))


def test_documents(spark, folder, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert got(documents) == want(texts.items())
    for r in QUERIES["op5_license"](spark, folder).collect():
        n, places, matches = brute(texts[r.doc_id])
        starts = [s for _, s in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(starts), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({p for p, _ in places}))
        assert r.labels == ",".join(sorted({p for p, _ in places} | {m for m, _ in matches})) and 0 <= r.score <= 1


def test_edges_and_empty(edge, none):
    assert got(edge) == want([(r[0], r[1]) for r in rows_of_edge()])
    assert license.scan_licenses(none).count() == 0


def test_only_ascii_letters_are_lowered(frame):
    """The Kelvin sign is no k, so a template word written with it is another word."""
    line = license.TEMPLATES["gpl-3.0"]
    texts = [line.upper(), line.upper().replace("K", "K")]
    got = {r.doc_id: r for r in license.scan_licenses(frame(texts)).collect()}
    assert got[0].n_words == got[1].n_words
    score = {i: max((m.score for m in got[i].matches if m.label == "gpl-3.0"), default=0.0) for i in (0, 1)}
    assert score[0] == 1.0 and score[1] == (len(license.template_words(line)) - 1) / len(license.template_words(line))
