import math
import random
import re

from crosslink.llm import licenses as L


def brute(text, rarity):
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = lambda phrase: [i for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    places = [(i, label) for p, label in L.PHRASES.items() for i in at(p)]
    starts, base = [i for i, _ in places], {x for _, x in places}
    score, more = 0.5 * bool(places), set()
    for (label, _, keys), t, ordered in zip(L.TEMPLATES, L.WORDS, rarity):
        if not {w for k in keys for w in k.split()} <= set(words):
            continue
        chosen = [w for w in ordered if w in words][: L.ANCHORS]  # the file's own rarest words of the template
        where = [(i, w) for i, w in enumerate(t) if w in chosen]
        for start in range(-len(t), len(words)):
            n = sum(0 <= start + i < len(words) and words[start + i] == w for i, w in where)
            fixed = all(start + next(i for i in range(len(t)) if t[i : i + len(k.split())] == k.split()) in at(k) for k in keys)
            if n >= math.ceil(L.SHARE * len(where)) and fixed:
                more.add(label)
                score = max(score, n / len(where))
    join = lambda s: ",".join(sorted(s))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), join(base), join(base | more), score


def test_brute_force(spark):
    r = random.Random(4)
    pieces = [t.replace("\n", " ") for _, t, _ in L.TEMPLATES] + list(L.PHRASES) + ["MIT License mit license!", "CC-BY", "word é x", "liKense mit licenſe", "the of a 4 0 2 license"]
    texts = [None, "", "...", "MIT LICENSE", "gnu general public license", "apache license apache license", "K cc by"]
    for _ in range(150):
        words = " , ".join(r.choice(pieces) for _ in range(r.randrange(1, 4))).split()
        for _ in range(r.randrange(3)):
            words[r.randrange(len(words))] = r.choice(["x", "License,", "gnu"])
        texts.append(r.choice([" ", "\n", "-"]).join(words[r.randrange(4) :]))
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)], "doc_id long, text string, labels string, n_words int")
    rarity = L.by_rarity(L.word_counts(docs))
    rows = L.scan(docs).collect()
    for x in rows:
        assert x[2:] == brute(texts[x.doc_id], rarity), texts[x.doc_id]
    assert len({x.labels for x in rows}) > 15


def test_counts(spark):
    counts = L.word_counts(spark.createDataFrame([("MIT mit license",), ("the mit",), (None,)], "text string"))
    assert (counts["mit"], counts["license"], counts["the"], counts["gnu"]) == (2, 1, 1, 0)
    assert L.word_counts(spark.createDataFrame([], "text string")) == dict.fromkeys(L.VOCABULARY, 0)
    order = L.by_rarity(counts)[[t[0] for t in L.TEMPLATES].index("gpl-3.0")]
    assert order.index("gnu") < order.index("the") < order.index("license") or order.index("gnu") < order.index("license") < order.index("the")


def test_edited_licence_keeps_its_label(spark):
    """A full licence whose rarest words are replaced is still found by the file's own next ones; one without its key phrase is not."""
    mit = next(t for label, t, _ in L.TEMPLATES if label == "mit" and len(t) > 100)
    edited = mit.replace("NONINFRINGEMENT", "x").replace("sublicense", "y").replace("TORT", "z")
    docs = spark.createDataFrame([(1, f"some words first\n{mit}"), (2, edited), (3, mit.replace("hereby", "now")), (4, " ".join(reversed(mit.split())))], "doc_id int, text string")
    got = {r.doc_id: (r.labels, r.score) for r in L.scan(docs).collect()}
    assert got[1][0] == got[2][0] == "mit" and got[1][1] == 1.0 and got[3] == got[4] == ("", 0.0)


def test_empty(spark):
    assert L.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_texts_of_licence_words(spark):
    """Work grows with the text, not with its square: a text of many template words is no more than its parts."""
    import time

    from crosslink.llm.licenses import TEMPLATES, WORDS

    words = WORDS[max(range(len(TEMPLATES)), key=lambda i: len(WORDS[i]))]
    took = []
    for times in (10, 10, 80):
        text = " ".join(words * times) + " " + " ".join(w for ws in WORDS for w in ws)
        began = time.time()
        row = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
        took.append(time.time() - began)
        assert row.n_words == len(text.split()) and set(t[0] for t in TEMPLATES) <= set(row.labels.split(","))
    assert took[2] < 8 * took[1] + 10
