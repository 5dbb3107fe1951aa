import random

from crosslink.llm import decontaminate as D


def table(pattern, text):
    """Least distance of the pattern to a substring that ends at each place."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != c)))
        row = new
    return row


def edited(r, s, n):
    for _ in range(n):
        i = r.randrange(len(s))
        s = r.choice([s[:i] + s[i + 1 :], s[:i] + r.choice("abc ") + s[i:], s[:i] + r.choice("xyz") + s[i + 1 :]])
    return s


def test_myers_equals_table():
    r = random.Random(0)
    for _ in range(300):
        p, t = ("".join(r.choice("abc") for _ in range(r.randrange(1, n))) for n in (90, 120))
        assert list(D.distances(p, t)) == table(p, t)[1:]


def test_places_equal_brute_force(spark):
    r = random.Random(3)
    make = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 7))) for _ in range(n))
    items = [(i, make(r.randrange(1, 30))) for i in range(12)] + [(12, None), (13, "  "), (14, "ab"), (3, "same id as another item here"), (None, "an item without an id of its own")]
    docs = []
    for i in range(80):
        text = make(r.randrange(30))
        for _ in range(r.randrange(3)):
            item = r.choice(items)[1] or ""
            text += " " + edited(r, item.upper() if r.random() < 0.3 else item, r.randrange(len(item) // 6 + 1)).replace(" ", r.choice([" ", " \n"])) + " " + make(5) if item.strip() else ""
        docs.append((i, text, "e"))
    docs += [(80, None, "e"), (81, "", "e"), (82, items[0][1], "e"), (82, items[0][1], "e"), (None, items[0][1], "e")]
    df, it = spark.createDataFrame(docs, "doc_id long, text string, end string"), spark.createDataFrame(items, "item_id long, text string")
    want = []
    for d, text, _ in docs:
        t = D.normal(text)
        for i, item in items:
            p = D.normal(item)
            if p and t and (best := min(table(p, t)[1:])) <= int(0.1 * len(p)):
                want.append((d, i, best))
    key = lambda x: tuple((v is not None, v or 0) for v in x)
    for chars in (D.ITEM_CHARS, 200):
        was, D.ITEM_CHARS = D.ITEM_CHARS, chars
        got = D.matches(df, it, 0.1).collect()
        clean = [tuple(x) for x in D.clean_documents(df, it, 0.1).collect()]
        D.ITEM_CHARS = was
        assert sorted(((x.doc_id, x.item_id, x.distance) for x in got), key=key) == sorted(want, key=key)
        hit = {d for d, _, _ in want}
        assert sorted(clean, key=key) == sorted((x for x in docs if x[0] not in hit), key=key)
        texts, named = {d: D.normal(t) for d, t, _ in docs}, {}
        for i, item in items:
            named.setdefault(i, []).append(D.normal(item))
        for x in got:
            part = texts[x.doc_id][x.start : x.end]
            assert min(table(p, part)[-1] for p in named[x.item_id] if p) <= x.distance
    assert len(want) > 40


def test_empty(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert D.matches(docs, items).count() == 0 and D.clean_documents(docs, items).count() == 0
