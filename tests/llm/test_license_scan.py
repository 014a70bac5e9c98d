import math
import random
import re

from ridelens.llm.license_scan import BASE, LEAST, RARE, SLACK, TEMPLATES, scan

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_by_hand(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in BASE.items():
        own = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_columns_match_a_count_by_hand(spark):
    rng = random.Random(8)
    pieces = ["MIT", "license", "Apache", "general", "public", "-", ".", "\n", "é", "K", "licenses", "mit license", "GPL"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(150)]
    texts += [None, "", "mit license " * 5000, "general PUBLIC, license; apache\nlicense"]
    docs = spark.createDataFrame([(i or None, t, "x") for i, t in enumerate(texts)] + [(7, texts[7], "y")], "doc_id long, text string, labels string")
    got = scan(docs).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_by_hand(texts[r.doc_id or 0])
        assert 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert scan(docs.limit(0)).count() == 0


def test_whole_templates_are_found_in_other_text_and_parts_are_not(spark):
    docs = [(t, f"Some words, then: {text.upper()}. And more of the same.") for t, (_, text, _) in enumerate(TEMPLATES)]
    docs += [(100, "permission is hereby granted free of charge to nobody"), (101, "plain words of the public")]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for t, (label, _, _) in enumerate(TEMPLATES):
        assert label in got[t].labels.split(",") and got[t].score > 0.99
    assert got[100].labels == got[101].labels == "" and got[100].score < 0.6 and got[101].score == 0


def test_several_licences_in_one_file_and_in_a_long_one(spark):
    whole = {label for label, _, _ in TEMPLATES}
    every = ". Then. ".join(text for _, text, _ in TEMPLATES)
    _, notice, _ = next(t for t in TEMPLATES if t[0] == "gpl")
    rare = "redistribute foundation gnu published modify program mozilla unencumbered redistribution merchantable"
    docs = [(0, every), (1, f"{notice}. Licensed under the Apache License Version 2.0"), (2, f"{notice}. All rights reserved."),
            (3, f"{rare} {'plain words ' * 20_000} all rights reserved {'plain words ' * 20_000} {rare}")]
    docs += [(k, "all rights reserved, licensed under the apache license version 2 0") for k in range(4, 40)]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert whole <= set(got[0].labels.split(","))
    assert {"gpl", "apache-2.0"} <= set(got[1].labels.split(","))
    assert {"gpl", "all-rights-reserved"} <= set(got[2].labels.split(","))
    assert got[3].labels == "all-rights-reserved" and got[3].score > 0.99


def plain_scan(texts):
    """labels and score of each text by trying every start of every template."""
    words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER)) for t in texts]
    seen = {}
    for own in words:
        for w in set(own):
            seen[w] = seen.get(w, 0) + 1
    idf = lambda w: math.log((len(texts) + 1) / (seen.get(w, 0) + 0.5)) + 1e-6
    out = []
    for text, own in zip(texts, words):
        base, labels, best = set(filter(None, base_by_hand(text)[4].split(","))), set(), 0.0
        held = set(own)
        for label, template, key in TEMPLATES:
            parts, phrase = template.split(), key.split()
            if not any(own[i : i + len(phrase)] == phrase for i in range(len(own))):
                continue
            total = sum(map(idf, parts))
            ordered = sorted(set(parts), key=lambda w: (-idf(w), w))
            many = next(n for n in range(len(ordered) + 1) if sum(idf(w) for w in parts if w not in ordered[:n]) < LEAST * total)
            rare = [w for w in ordered if w in held][: max(RARE, many)]
            for start in {i - k for i, w in enumerate(own) if w in rare for k, p in enumerate(parts) if p == w}:
                found = sum(idf(w) for k, w in enumerate(parts) if w in own[max(0, start + k - SLACK) : max(0, start + k + SLACK + 1)])
                score = round(found / total, 9)
                best = max(best, score)
                labels |= {label} if score >= LEAST else set()
        out.append((",".join(sorted(base | labels)), best))
    return out


def test_labels_and_scores_are_those_of_every_start_tried(spark):
    rng = random.Random(12)
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 3)):
            own = rng.choice(TEMPLATES)[1].split()
            for _ in range(rng.randint(0, 4)):
                k = rng.randrange(len(own) + 1)
                own[k : k + rng.randint(0, 1)] = [rng.choice(["any", "one", "the", "license", "zebra"])] * rng.randint(0, 1)
            parts += [*own, *rng.choices(["plain", "words", "of", "the", "public", "software"], k=rng.randint(0, 9))]
        texts.append(" ".join(parts))
    texts += [None, "", "plain words"]
    got = {r.doc_id: (r.labels, r.score) for r in scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, (labels, score) in enumerate(plain_scan(texts)):
        assert got[i][0] == labels and abs(got[i][1] - score) < 1e-6


def test_an_inserted_word_does_not_lose_the_rest(spark):
    _, mit, _ = TEMPLATES[1]
    texts = [mit.replace("any person", "any one person"), mit.replace(" this software", ""), "Licensed under the Mozilla Public License, v. 2.0"]
    texts += ["plain words"] * 20
    got = {r.doc_id: r for r in scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert "mit" in got[0].labels and got[0].score > 0.99
    assert "mit" in got[1].labels and got[1].score > 0.85
    assert all(r.score == 0 for i, r in got.items() if i > 2)
