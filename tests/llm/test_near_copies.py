"""Near-duplicate texts and repeated lines against brute force, and the components they rest on."""

import collections
import random
import time

import pytest
from pyspark.sql import functions as F

from eventloom.llm import line_dedup, order_minhash
from eventloom.llm.common import stage
from eventloom.llm.components import components


def lev(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def changed(rnd, items, letters, most):
    out = list(items)
    for _ in range(rnd.randint(0, most)):
        k, kind = rnd.randint(0, len(out)), rnd.random()
        out[k:k + (kind < 0.67)] = [] if kind < 0.33 else [rnd.choice(letters)]
    return out


def test_banded_alignment_is_exact_within_the_band():
    rnd = random.Random(1)
    for _ in range(3000):
        a = [rnd.choice("abcdef") for _ in range(rnd.randint(0, 25))]
        b, most = changed(rnd, a, "abcx", 8), rnd.randint(0, 9)
        d = lev(a, b)
        assert order_minhash.edits(a, b, most) == (d if d <= most else None)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_bit_parallel_distance_of_columns(spark, edits):
    rnd, rows = random.Random(edits), []
    for _ in range(800):
        a = "".join(rnd.choice("abé日") for _ in range(rnd.randint(0, 14)))
        b = "".join(changed(rnd, a, "abc", 4))
        a, b = sorted((a, b), key=len)
        if len(b) - len(a) <= edits:
            rows.append((a, b, lev(a, b)))
    df = spark.createDataFrame(rows, "a string, b string, d int").withColumn("x", line_dedup.distance(F.col("a"), F.col("b"), edits))
    assert df.filter(f"(d <= {edits} OR x <= {edits}) AND d <> x").count() == 0


def test_segments_of_near_lines_always_meet():
    """The substrings that a line looks up hold an unchanged segment of every line within the edits."""
    rnd = random.Random(9)

    def cut(text, length, i, parts, shift=0):
        base, longer = divmod(length, parts)
        start = (i - 1) * base + max(0, i - 1 - (parts - longer))
        return text[start + shift:start + shift + base + (i > parts - longer)]

    for edits in (1, 2, 3):
        for _ in range(1500):
            a = "".join(rnd.choice("ab") for _ in range(rnd.randint(12, 30)))
            b = "".join(changed(rnd, a, "ab", edits))
            a, b = sorted((a, b), key=len)
            if lev(a, b) <= edits:
                own = {(len(a), i, cut(a, len(a), i, edits + 1)) for i in range(1, edits + 2)}
                looked = {(len(b) - less, i, cut(b, len(b) - less, i, edits + 1, shift)) for less, i, shift in line_dedup.selections(edits)}
                assert own & looked


def union_find(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(2)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(rnd.randint(200, 230), 999) for _ in range(30)]
    links = [*chain, *star, *[(rnd.randint(300, 400), rnd.randint(300, 400)) for _ in range(70)], (5, 5), (7, 6), (6, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links for x in (a, b) if a != b}
    assert got == union_find(nodes, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def documents():
    rnd = random.Random(12)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(600)]

    def text(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    passage, out = text(60), [None, None, "", "", "!?", "?!", "one", "One!", "one two", "x" * 40000]
    for _ in range(25):
        base = text(rnd.randint(40, 150))
        out.append(" ".join(base))
        for _ in range(rnd.choice([0, 1, 3])):
            near = list(base)
            for _ in range(rnd.randint(0, 2)):
                near[rnd.randrange(len(near))] = "zzz"
            out.append(", ".join(near).upper() if rnd.random() < 0.3 else " ".join(near))
        out.append(" ".join(base[len(base) // 2:] + base[:len(base) // 2]))  # the same words in another order
        out.append(" ".join(passage + text(rnd.randint(30, 60))))
    hub = text(100)
    for k in range(60):  # copies of one, each changed elsewhere
        near = list(hub)
        near[k], near[(k * 7 + 3) % 100] = f"c{k}", "yyy"
        out.append(" ".join(near))
    out += ["exact copy of a text that is found again"] * 30
    rnd.shuffle(out)
    return [(k if k % 17 else None, t) for k, t in enumerate(out)] + [(3, out[3])]


def test_classes_equal_brute_force(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS KEEP", "1 AS key", "2 AS node")
    got = order_minhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    texts = sorted({t for _, t in rows if t is not None})
    links = [(a, b) for k, a in enumerate(texts) for b in texts[k + 1:] if order_minhash.words_of(a) and order_minhash.similar(a, b)]
    root = union_find(texts, links)
    least = collections.defaultdict(lambda: 1 << 63)
    for doc_id, t in rows:
        if t is not None and doc_id is not None:
            least[root[t]] = min(least[root[t]], doc_id)
    size = collections.Counter(root.values())
    for r in got:
        if r.text is None:
            assert (r.class_id, r.class_texts, r.keep) == (r.doc_id, 1, True)
        else:
            first = least[root[r.text]]
            assert (r.class_id, r.class_texts) == (None if first == 1 << 63 else first, size[root[r.text]])
    kept = collections.Counter(root[r.text] for r in got if r.keep and r.text is not None and (r.doc_id, r.text) != (3, rows[3][1]))
    assert all(n == 1 or least[c] == 1 << 63 for c, n in kept.items())
    assert order_minhash.near_duplicates(df.limit(0)).count() == 0


def test_links_at_the_bound_are_found_however_the_edits_lie(spark, monkeypatch):
    """Every fifth word replaced leaves no run of five words; a line that many texts share is a frequent run."""
    monkeypatch.setattr(order_minhash, "FREQUENT", 20)
    rnd, texts = random.Random(31), []
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    line = [word() for _ in range(8)]
    for k, n in enumerate([5, 6, 9, 10, 14, 15, 20, 40, 100, 150, 400, 900] + [30] * 40):
        base = (line if n == 30 else []) + [word() for _ in range(n)]
        texts += [base, [word() if at % 5 == k % 5 else w for at, w in enumerate(base)]]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    links = [(a, b) for k, (a, x) in enumerate(rows) for b, y in rows[k + 1:] if order_minhash.similar(x, y)]
    assert len(links) > 25
    assert got == union_find(list(got), links)


def test_signatures_and_spare_runs_let_links_pass():
    rnd = random.Random(32)
    for _ in range(400):
        a = [rnd.choice("abcdefghijklmnopqrstuvwxyz") * rnd.choice([1, 2, 9]) for _ in range(rnd.randint(1, 300))]
        b = list(a)
        for _ in range(order_minhash.most_edits(len(a), 0.8)):
            b[rnd.randrange(len(b))] = "zzz"
        (x, y) = (order_minhash.sketch(" ".join(t)) for t in (a, b))
        assert len(set(x[3]) & set(y[3])) > max(x[5], y[5])
        assert sum(((p ^ q) & (1 << 64) - 1).bit_count() for p, q in zip(x[4], y[4])) <= order_minhash.most_bits(0.8)


def line_documents():
    rnd, letters = random.Random(3), "abcdefgh "
    lines = ["".join(rnd.choice(letters) for _ in range(rnd.randint(25, 70))) for _ in range(60)]
    out = [None, "", "\n\n", "short\nshort", "short"]
    for _ in range(70):
        own = ["".join(rnd.choice(letters) for _ in range(rnd.randint(20, 80))) for _ in range(rnd.randint(2, 6))]
        own += ["".join(changed(rnd, rnd.choice(lines), letters, 3)) for _ in range(rnd.randint(0, 3))]
        rnd.shuffle(own)
        out.append("\n".join(own))
    out += ["\n".join(lines[:9])] * 4 + ["\r\n".join(lines[9:12]) + "\n" + "y" * 9000, "z" * 40 + "\n" + "z" * 40]
    rnd.shuffle(out)
    return [(k if k % 13 else None, t) for k, t in enumerate(out)] + [(7, out[7])]


@pytest.mark.parametrize("edits", [1, 2])
def test_repeated_lines_equal_brute_force(spark, edits):
    rows, late = line_documents(), (1 << 63) - 1
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS Dropped", "1 AS id", "2 AS line", "3 AS doc")
    got = line_dedup.dedup_lines(df, edits=edits).collect()
    assert len(got) == len(rows)
    places = collections.defaultdict(set)
    for doc_id, t in rows:
        for at, line in enumerate((t or "").split("\n")):
            if len(line) >= line_dedup.MIN_CHARS:
                places[line].add((late if doc_id is None else doc_id, at))
    beside = {x: [y for y in places if x != y and abs(len(x) - len(y)) <= edits and lev(x, y) <= edits] for x in places}
    assert sum(map(len, beside.values())) > 10
    for r in got:
        doc, lines = late if r.doc_id is None else r.doc_id, (r.text or "").split("\n")
        repeats = [at for at, x in enumerate(lines) if x in places and min(min(places[y]) for y in [x, *beside[x]]) < (doc, at)]
        whole = sum(len(lines[k]) for k in repeats) > 0.5 * len(r.text or "")
        assert r.n_repeats == len(repeats) and r.dropped == ([] if whole else repeats)
        assert r.n_lines == (0 if r.text is None else len(lines))
        assert r.n_links == sum(len(beside.get(x, ())) for x in lines)
        assert r.kept_text == (None if r.text is None else "\n".join(x for k, x in enumerate(lines) if k not in r.dropped))
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_lines_are_joined_without_python(spark):
    docs = spark.createDataFrame(line_documents(), "doc_id long, text string")
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_only_near_copies_of_one_document_are_spared(spark):
    rnd = random.Random(21)

    def lines(n):
        return ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(40, 70))) for _ in range(n)]

    a, b, c, hot = lines(10), lines(10), lines(12), lines(1)
    mixed = [*a[:5], *b[:5]]
    texts = {1: a, 2: b, 3: c, 4: [*a[2:8], *lines(1)],  # a short text of its own beside a long shared passage
             5: [*a[:4], *b[:4], *lines(1)],  # from two documents
             6: [*c[:11], *lines(1)], 7: c,  # a near copy and a copy
             8: hot * 9, 9: [*hot * 9, *lines(1)],  # repeats its own line; a near copy of such a text
             10: [*c, *lines(12)], 11: c[:3],  # twice as long as what it holds; a part of one document
             12: mixed, 13: [x + "!" for x in mixed]}  # the second is a near copy of the first, but its lines are first elsewhere
    rows = [(k, "\n".join(x)) for k, x in texts.items()] + [(None, "\n".join(a)), (7, "\n".join(c))]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), max_repeated=None).collect()}
    assert {k: r.dropped for k, r in got.items()} == {
        1: [], 2: [], 3: [], 4: [*range(6)], 5: [*range(8)], 6: [], 7: [], 8: [*range(1, 9)], 9: [], 10: [*range(12)], 11: [0, 1, 2],
        12: [*range(10)], 13: [], None: []}
    assert got[4].kept_text == texts[4][-1] and got[6].n_repeats == 11


def test_short_lines_are_compared_with_fewer_edits(spark):
    rnd = random.Random(22)

    def own():
        return "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(60, 90)))

    seen = ["All rights reserved.", "Les.", "x", "Terms and conditions of use ok", own()]  # 20, 4, 1 and 30 characters
    again = ["All rights reserved!", "All right reserved!!", "Les.", "Lee.", "x", "Terms and conditions of use OK", "Terms and conditions of use",
             "Terms and conditions of use o", " ", "", " ", ""]
    docs = spark.createDataFrame([(1, "\n".join(seen)), (2, "\n".join([*again, *[own() for _ in range(4)]]))], "doc_id long, text string")
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(docs, min_chars=1, max_repeated=None).collect()}
    limit = [0 if n < 15 else 1 if n < 30 else 2 for n in range(100)]
    places = [(d, k, x) for d, t in enumerate((seen, again)) for k, x in enumerate(t) if x.strip()]
    repeats = [k for d, k, x in places if d == 1 and any((e, j) < (d, k) and lev(x, y) <= limit[min(len(x), len(y))] for e, j, y in places)]
    assert rows[2].dropped == repeats == [0, 2, 4, 5, 7] and rows[1].dropped == []
    assert rows[2].n_repeats == 5 and rows[1].n_links == 3
    kept = line_dedup.dedup_lines(docs, min_chars=1, max_repeated=None, min_dropped=10).filter("doc_id = 2").first()
    assert kept.n_repeats == 5 and kept.dropped == [0, 5, 7]


def test_lines_of_every_length_equal_brute_force(spark):
    """What the registered query does, against all pairs of lines and of documents."""
    rows, late = line_documents(), (1 << 63) - 1
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_chars=1, max_repeated=None).collect()
    docs = {(late if k is None else k, t) for k, t in rows if t}
    lines = {x for _, t in docs for x in t.split("\n") if x.strip()}
    most = {x: 0 if len(x) < 15 else 1 if len(x) < 30 else 2 for x in lines}

    def close(x, y):
        return x == y or abs(len(x) - len(y)) <= (m := min(most[x], most[y])) and m and lev(x, y) <= m

    beside = {x: {y for y in lines if close(x, y)} for x in lines}
    first = {x: min((d, k) for d, t in docs for k, y in enumerate(t.split("\n")) if y == x) for x in lines}

    def size(t):
        return len(t.replace("\n", ""))

    def covers(t, u):
        one, two = (collections.Counter(x for x in z.split("\n") if x in lines) for z in (t, u))
        shared = sum(len(x) * min(n, sum(two[y] for y in beside[x])) for x, n in one.items())
        return shared >= 0.8 * max(size(t), size(u))

    spared = 0
    for r in got:
        doc = late if r.doc_id is None else r.doc_id
        split = (r.text or "").split("\n")
        repeats = [k for k, x in enumerate(split) if x in lines and min(first[y] for y in beside[x]) < (doc, k)]
        copy = bool(r.text) and any(d < doc and covers(r.text, t) for d, t in docs)
        spared += bool(copy and repeats)
        assert r.n_repeats == len(repeats) and r.dropped == ([] if copy else repeats)
    assert spared > 2


def test_a_stage_leaves_no_shuffle_files(spark):
    def files():
        found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(k).getName() for k in range(found.size())}

    before = files()
    rows = stage(spark.range(100_000).selectExpr("id % 1000 AS k").groupBy("k").count(), "counted")
    end = time.monotonic() + 30  # the executors are told, and not waited for
    while (left := {f for f in files() - before if f.startswith("shuffle_") and f.endswith(".data")}) and time.monotonic() < end:
        time.sleep(0.2)
    assert not left and rows.count() == 1000


def test_texts_of_other_nodes_stay_out_of_the_shuffle(spark):
    docs = spark.createDataFrame([(f"text {k % 5000}",) for k in range(6000)], "text string")
    nodes = docs.select(order_minhash._node().alias("node"), "text").filter("text LIKE '%7'").select("node").distinct()
    texts = order_minhash._texts_of(docs, nodes, "texts")
    assert sorted(r.text for r in texts.collect()) == sorted(f"text {k}" for k in range(7, 5000, 10))
    passed = docs.filter(order_minhash._perhaps(nodes)(order_minhash._node())).distinct().count()
    assert 500 <= passed < 800
    assert order_minhash._texts_of(docs, nodes.limit(0), "texts").count() == 0
