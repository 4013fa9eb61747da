import random

from spanwright.llm.components import connected_components
from spanwright.llm.neardup import near_duplicates

KIND = "doc_id long, text string"


def brute(rows):
    sets = {}
    for i, t in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        n = max(len(words) - 4, min(len(words), 1))
        sets[i] = {tuple(words[k : k + 5]) for k in range(n)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def check(spark, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, KIND)).collect()}
    assert got == brute(rows)


def edited(words, r, n):
    out = list(words)
    for _ in range(n):
        out[r.randrange(len(out))] = f"edit{r.randrange(10**6)}"
    return " ".join(out)


def test_groups_of_copies_chains_and_shared_passages(spark):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, passage = [], " ".join(r.choice(vocabulary) for _ in range(60))
    for _ in range(4):
        base = [r.choice(vocabulary) for _ in range(r.choice((30, 80, 150)))]
        rows += [edited(base, r, r.randint(0, 6)) for _ in range(25)]
    rows += [passage + " " + " ".join(r.choice(vocabulary) for _ in range(r.randint(20, 80))) for _ in range(40)]
    r.shuffle(rows)
    check(spark, list(enumerate(rows)))


def test_nulls_short_and_equal_texts(spark):
    texts = [None, "", " \t\n", "one", "one", "ONE", "one two", "a b c d e", "A b  c d\te", "a b c d e f", "é b c d e", "É b c d e"]
    check(spark, list(enumerate(texts)))


def test_empty_table_repeated_and_null_keys_and_extra_columns(spark):
    assert near_duplicates(spark.createDataFrame([], KIND)).count() == 0
    text = "a b c d e f g h"
    rows = [(7, text, 1, 2), (7, text, 3, 4), (9, text, 5, 6), (None, text, 7, 8)]
    got = near_duplicates(spark.createDataFrame(rows, KIND + ", component_id int, n_shingles int")).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in got if r.doc_id) == [(7, 7, True), (7, 7, True), (9, 7, False)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5), (1, 0)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_that_share_a_key_are_told_apart(spark):
    r = random.Random(3)
    a, b, c = ([f"{n}{r.randrange(10**6)}" for _ in range(120)] for n in "abc")
    near = lambda words, at: " ".join(words[:at] + ["edit"] + words[at + 1 :])
    # 5 and 7 share b, 7 and 9 share a and c; 8 is two near copies, 6 one text twice.
    rows = [(5, " ".join(b)), (7, " ".join(a)), (7, near(b, 30)), (7, " ".join(c)), (9, near(a, 60)), (9, near(c, 60)), (8, "x y z " * 5 + "one"), (8, "x y z " * 5 + "one"), (8, "u " + "x y z " * 5 + "one"), (6, "one text"), (6, "one text"), (4, None), (4, "a word")]
    got = near_duplicates(spark.createDataFrame(rows, KIND), text_hash=True).collect()
    of = {}
    texts = {x.h: x.text for x in spark.createDataFrame(rows, KIND).selectExpr("text", "xxhash64(text) h").collect()}
    for x in got:
        of.setdefault((x.doc_id, texts[x.text_hash]), set()).add((x.component_id, x.kept))
    assert len(got) == len(rows) and all(len(v) == 1 for v in of.values())
    of = {k: v.pop() for k, v in of.items()}
    for i, text, component, kept in [(5, 0, 5, True), (7, 1, 7, True), (7, 2, 5, False), (7, 3, 7, True), (9, 4, 7, False), (9, 5, 7, False), (6, 9, 6, True), (4, 11, 4, True), (4, 12, 4, True)]:
        assert of[i, rows[text][1]] == (component, kept)
    assert sorted(v for k, v in of.items() if k[0] == 8) == [(8, False), (8, True)]


def test_long_texts_are_verified_on_full_sets(spark):
    r = random.Random(8)
    rows = []
    for _ in range(2):
        base = [f"w{r.randrange(5000)}" for _ in range(2600)]
        copies = [edited(base, r, r.choice((0, 3, 30, 45, 60, 75, 90))).split() for _ in range(14)]
        # Copies of copies, and parts that are too short to be near.
        rows += [" ".join(c) for c in copies] + [edited(c, r, 40) for c in copies[:6]] + [" ".join(base[: r.choice((900, 1100, 1500, 2000, 2300))]) for _ in range(6)]
    r.shuffle(rows)
    check(spark, list(enumerate(rows)))


def test_long_lists_are_dealt_in_blocks(spark, monkeypatch):
    from spanwright.llm import neardup

    monkeypatch.setattr(neardup, "BLOCK", 3)
    r = random.Random(9)
    base = [f"w{i}" for i in range(90)]
    # Far from the first copy, near to each other: found only by the second lists.
    rows = [" ".join(base)] + [edited(edited(base, r, 5).split(), r, 1) for _ in range(60)]
    rows += [edited(rows[r.randrange(1, 60)].split(), r, 2) for _ in range(40)]
    check(spark, list(enumerate(rows)))
