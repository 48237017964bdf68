"""The llm operators against brute force, exact round trips and edge cases."""

import random
import unicodedata

import pytest
from helpers import rows

from chronofold.llm import grouped_split, leakage, lookalike, packing, textform


def brute_components(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("floor", [5, 500_000])
def test_components(spark, floor):
    r = random.Random(1)
    edges = [(f"{r.randrange(120):03}", f"{r.randrange(120):03}") for _ in range(70)] + [(f"c{i:03}", f"c{i + 1:03}") for i in range(40)] + [("hub", f"h{i}") for i in range(30)]
    df = spark.createDataFrame([*edges, *edges[:5], (None, "x"), ("solo", "solo")], "u string, v string")
    got = dict(rows(grouped_split.components(df, floor=floor)))
    assert got == brute_components(edges) | {"solo": "solo"}
    assert grouped_split.components(df.limit(0)).count() == 0


def test_related_keeps_every_record(spark):
    data = [(1, "a", None), (2, "a", 5), (3, "b", 5), (4, None, 6), (5, None, None), (6, None, None), (7, "c", 7), (7, "c", 7)]
    df = spark.createDataFrame(data, "id int, author string, source int")
    got = rows(grouped_split.related(df, ["author", "source"], "id"), "id", "component")
    by = {}
    for i, c in got:
        by.setdefault(c, []).append(i)
    assert sorted(by.values()) == [[1, 2, 3], [4], [5], [6], [7, 7]]


@pytest.mark.parametrize("floor", [5, 500_000])
def test_related_against_brute_force(spark, floor):
    """Three keys of whole numbers with nulls, chains through every key, and a hub that a third of all records share."""
    r = random.Random(8)
    data = [(i, *(None if r.random() < 0.3 else r.randrange(60) for _ in range(2)), 7 if i % 3 == 0 else None if r.random() < 0.5 else r.randrange(10, 90)) for i in range(120)]
    edges = [((k, v), (k2, v2)) for _, *of in data for k, v in enumerate(of) for k2, v2 in enumerate(of) if v is not None and v2 is not None]
    root = brute_components(edges)
    want = {}
    for i, *of in data:
        first = next(((k, v) for k, v in enumerate(of) if v is not None), None)
        want.setdefault(root[first] if first else ("own", i), set()).add(i)
    for kind in ("int", "string"):
        df = spark.createDataFrame([(i, *(v if v is None or kind == "int" else str(v) for v in of)) for i, *of in data], f"id int, a {kind}, b {kind}, c {kind}")
        got = {}
        for i, c in rows(grouped_split.related(df, ["a", "b", "c"], "id", floor=floor), "id", "component"):
            got.setdefault(c, set()).add(i)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())), kind


def test_scaled_subset_sums_stay_close():
    r = random.Random(12)
    for _ in range(30):
        have = {r.randrange(1, 10**9): r.randrange(1, 50) for _ in range(6)} | {1: 10**6, 1000: 10**5, 10**5: 10**5}
        classes = {(10 * s, s): m for s, m in have.items()}
        target, sums = r.randrange(10**9, 10**10), 1 << 14
        for have, weight, got in (
            (have, lambda s: s, grouped_split.closest_subset(have, target, sums)),
            (classes, lambda c: c[1], grouped_split.balanced_subset(classes, target, 0, 10**11, (10**11, 10**10), sums)),
        ):
            assert all(0 < k <= have[c] for c, k in got.items())
            assert abs(sum(weight(c) * k for c, k in got.items()) - target) <= 1


def test_large_components_share_classes(spark):
    """Counts beyond 256 rows share a class, and no component is torn."""
    data = [(s, 1000 * s + i, int(i < s % 3)) for s in range(40) for i in range(1 if s % 2 else 250 + 7 * s)]
    df = spark.createDataFrame(data, "subject_id int, hadm_id int, target int")
    out = rows(grouped_split.grouped_split(df, ["subject_id", "hadm_id"], "hadm_id", "target", {"train": 0.7, "test": 0.15, "deployment": 0.15}), "subject_id", "split")
    assert len(out) == len(data) and len(set(out)) == 40
    for name in ("test", "deployment"):
        assert abs(sum(x[1] == name for x in out) / len(data) - 0.15) < 0.03


def test_closest_subset_is_exact():
    r = random.Random(4)
    for _ in range(60):
        have = {r.randrange(1, 40): r.randrange(1, 6) for _ in range(5)}
        target = r.randrange(1, 200)
        sums = {0}
        for s, m in have.items():
            sums = {x + k * s for x in sums for k in range(m + 1)}
        got = grouped_split.closest_subset(have, target)
        assert all(0 < k <= have[s] for s, k in got.items())
        assert abs(sum(s * k for s, k in got.items()) - target) == min(abs(x - target) for x in sums)


def test_grouped_split(spark):
    r = random.Random(2)
    data, i = [], 0
    for subject in range(600):
        for _ in range(300 if subject == 0 else r.randrange(1, 5)):
            data.append((subject, i, 1 if r.random() < 0.05 else r.choice([0, None])))
            i += 1
    df = spark.createDataFrame(data, "subject_id int, hadm_id int, target int")
    out = rows(grouped_split.grouped_split(df, ["subject_id", "hadm_id"], "hadm_id", "target", {"train": 0.7, "test": 0.15, "deployment": 0.15}), "subject_id", "hadm_id", "target", "split")
    assert sorted((a, b) for a, b, _, _ in out) == sorted((a, b) for a, b, _ in data)
    of = {}
    for s, _, _, split in out:
        of.setdefault(s, set()).add(split)
    assert all(len(x) == 1 for x in of.values())
    positives = sum(t == 1 for _, _, t in data)
    for name in ("test", "deployment"):
        assert abs(sum(x[3] == name for x in out) - 0.15 * len(data)) <= 1
        assert abs(sum(x[3] == name and x[2] == 1 for x in out) - 0.15 * positives) <= 2
    assert grouped_split.grouped_split(df.limit(0), ["subject_id"], "hadm_id", "target", {"train": 1.0}).count() == 0


def split_totals(classes, shares):
    """(rows, positives) of each split of a plan, the first with what is left."""
    plan = grouped_split.quotas(classes, shares)
    assert all(sum(q[1:]) <= classes[c] and min(q) >= 0 for c, q in plan.items())
    got = [[sum(c[i] * q[s] for c, q in plan.items()) for i in (0, 1)] for s in range(1, len(shares))]
    whole = [sum(c[i] * m for c, m in classes.items()) for i in (0, 1)]
    return [[whole[i] - sum(g[i] for g in got) for i in (0, 1)], *got]


@pytest.mark.parametrize(
    "classes",
    [
        {(10000, 3): 1, (2, 1): 60, (1, 0): 19880},
        {(10000, 2): 1, (3, 1): 61, (1, 0): 19817},
        {(4000, 4): 3, (3, 1): 40, (1, 0): 17880},
        {(10000, 1): 1, (2, 2): 30, (1, 0): 19940},
    ],
)
def test_large_components_keep_rows_and_positives_close(classes):
    rows, positives = (sum(c[i] * m for c, m in classes.items()) for i in (0, 1))
    for got_rows, got_positives in split_totals(classes, (0.7, 0.15, 0.15))[1:]:
        assert abs(got_rows - 0.15 * rows) <= 1 and abs(got_positives - 0.15 * positives) <= 1.5


def test_large_component_goes_where_it_fits():
    for c in ((10000, 0), (10000, 5)):
        for shares in ((0.1, 0.8, 0.1), (0.1, 0.1, 0.8), (0.8, 0.1, 0.1)):
            got = split_totals({c: 1, (2, 1): 50, (1, 0): 9900}, shares)
            assert all(abs(g[0] - x * 20000) <= 1 for g, x in zip(got, shares, strict=True))


def test_balanced_subset_is_exact():
    from itertools import product

    r = random.Random(5)
    for _ in range(60):
        have = {(r.choice([1, 3, 40, 200]) + r.randrange(5), r.randrange(1, 6)): r.randrange(1, 4) for _ in range(4)}
        goal, most = r.randrange(1, 14), r.randrange(0, 260)
        least, scale = -100, (100, goal)

        def cost(taken):
            n, p = (sum(c[i] * k for c, k in taken.items()) for i in (0, 1))
            return abs(p - goal) / scale[1] + max(0, n - most, least - n) / scale[0]  # noqa: B023

        got = grouped_split.balanced_subset(have, goal, least, most, scale)
        assert all(0 < k <= have[c] for c, k in got.items())
        assert cost(got) == pytest.approx(min(cost(dict(zip(have, k, strict=True))) for k in product(*[range(m + 1) for m in have.values()])))


def test_torn(spark):
    stays = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (2, 21), (3, 30), (3, 30), (4, None)], "s int, h int")
    given = spark.createDataFrame([(10, "Train "), (11, "TEST"), (20, "train"), (21, None), (30, "test"), (30, "train"), (None, "x")], "h int, split string")
    assert rows(grouped_split.torn(grouped_split.related(stays, ["s", "h"], "h"), given, "h", "split", "s")) == [(1,), (3,)]


TEXTS = ["", "one", "two words", "x" * 5000, "ή" * 700, "many words " * 900, "tail  blanks  ", None, "🙂" * 300, *(" ".join(["word"] * k) for k in range(1, 90))]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_pack_round_trip(spark, name):
    path = f"/opt/tokenizers/{name}"
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate([*TEXTS, *TEXTS])], "id int, text string, row_no int")
    got = packing.pack(docs, "id", "text", 128, path).collect()
    count = packing.counter(path)
    room, texts = {}, {}
    for r in sorted(got, key=lambda r: (r["id"], r["piece_no"])):
        assert count([r["text"]])[0] == r["n_tokens"]
        room.setdefault(r["container_id"], []).append((r["token_offset"], max(1, r["n_tokens"])))
        texts.setdefault(r["id"], []).append(r["text"])
        assert r["start_char"] == sum(map(len, texts[r["id"]][:-1]))
    assert ["".join(texts[i]) for i in range(len(texts))] == [t or "" for t in [*TEXTS, *TEXTS]]
    for spans in room.values():
        spans.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(spans, spans[1:], strict=False)) and spans[-1][0] + spans[-1][1] <= 128
    for i, t in enumerate([*TEXTS, *TEXTS]):
        if count([t or ""])[0] <= 128:
            assert len(texts[i]) == 1
    assert packing.pack(docs.limit(0), "id", "text", 128, path).count() == 0
    assert rows(packing.unpack(packing.pack(docs, "id", "text", 128, path), 128)) == sorted(((i, t or "") for i, t in enumerate([*TEXTS, *TEXTS])), key=repr)


def test_plan_holds_every_item_once():
    r = random.Random(3)
    for _ in range(50):
        cap = r.choice([8, 64, 300])
        hist = {r.randrange(1, cap + 1): r.randrange(1, 500) for _ in range(r.randrange(1, 40))}
        plan, total = packing.plan_containers(hist, cap)
        load = [0] * total
        for size, runs in plan.items():
            at = 0
            for rank, many, per, first, offset in runs:
                assert rank == at
                at += many
                for k in range(many):
                    assert load[first + k // per] == offset + k % per * size
                    load[first + k // per] += size
            assert at == hist[size]
        assert max(load) <= cap and min(load) > 0


def test_length_buckets_are_optimal():
    from itertools import combinations

    r = random.Random(9)
    for _ in range(20):
        hist = {r.randrange(1, 60): r.randrange(1, 50) for _ in range(7)}
        sizes = sorted(hist)

        def cost(ends):
            total, low = 0, 0
            for e in ends:
                total += -(-sum(m for s, m in hist.items() if low < s <= e) // (64 // e))
                low = e
            return total

        got = packing.length_buckets(hist, 64, 3)
        best = min(cost((*c, sizes[-1])) for k in range(3) for c in combinations(sizes[:-1], k))
        assert got[-1] == sizes[-1] and len(got) <= 3 and cost(got) == best
    assert packing.length_buckets({}, 64) == []


def test_bucket_batches_fit(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    got = packing.bucket_batches(docs, "id", "text", 128, 4).collect()
    load = {}
    for r in got:
        load[(r["bucket_end"], r["container_id"])] = load.get((r["bucket_end"], r["container_id"]), 0) + r["n_tokens"]
    assert max(load.values()) <= 128
    assert {i: "".join(r["text"] for r in sorted((x for x in got if x["id"] == i), key=lambda r: r["piece_no"])) for i in range(len(TEXTS))} == {i: t or "" for i, t in enumerate(TEXTS)}


def test_skeleton():
    same = [("Ａｂ　c", "Ab c"), ("Ab\u00a0c", "Ab c"), ("cafe\u0301", "café"), ("so\u00adft\u200b", "soft"), ("асе", "ace"), ("Ηοn", "Hon"), ("ӧ", "ö"), ("ﬁ", "fi")]
    same += [(x, y) for x, y in zip("ɑνραıӏօᎪⲟ\u2010𝐀ꓐ", "avpailoAo-AB", strict=True)] + [("ά", "á"), ("Ⅳ", "IV"), ("…", "...")]
    assert all(textform.skeleton(a) == textform.skeleton(b) for a, b in same)
    assert len({textform.skeleton(t) for t in ("Abc", "abc", "ábc", "abc.", "ab c", "cba")}) == 6
    different = [("x²", "x2"), ("™", "TM"), ("①", "1"), ("½", "1\u20442"), ("´", " \u0301"), ("ſ", "s"), ("\u2019", "'"), ("—", "-")]
    assert all(textform.skeleton(a) != textform.skeleton(b) for a, b in different)
    assert textform.words("АВН АВн, Αβή2!") == textform.words("авн авн αΒΉ2")
    assert textform.words("ΝΟΜΟΣ") == textform.words("νομος") and textform.words("value") == textform.words("νalue")
    assert textform.words("soft\u00adhyphen, été") == [textform.words("softhuphen")[0], "e\u0301te\u0301"]
    assert textform.words(None) == textform.words("  ...") == []


def test_skeleton_is_idempotent():
    r = random.Random(14)
    pool = [chr(c) for c in range(0x20, 0x3000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")] + [chr(c) for c in range(0xFB00, 0xFFEF) if unicodedata.category(chr(c)) != "Cn"]
    for _ in range(3000):
        once = textform.skeleton("".join(r.choice(pool) for _ in range(6)))
        assert textform.skeleton(once) == once


def test_confusables_file(spark, tmp_path):
    path = tmp_path / "confusables.txt"
    path.write_text("# Source ; Target ; Type\n006D ;\t0072 006E ;\tMA\t# m to rn\n0430 ;\t0061 ;\tMA\n", encoding="utf-8")
    df = spark.createDataFrame([(1, "modеrn"), (2, "rnodеm"), (3, "mаd"), (4, "mad"), (5, None)], "id int, text string")
    classes = {i: c for i, c, _ in rows(lookalike.variant_members(lookalike.look_groups(df, "id", "text", str(path))), "id", "class_id", "n_forms")}
    assert classes == {1: 1, 2: 1, 3: 3, 4: 3}


@pytest.mark.parametrize("floor", [5, 500_000])
def test_variant_pairs(spark, floor):
    forms = ["page", "pаge", "Page", "ｐage", "pagé", "pagé", ""]
    r = random.Random(6)
    data = [(i, r.choice([*forms, *["page"] * 6])) for i in range(90)] + [(1000, None), (1001, None)]
    hashed = lookalike.look_groups(spark.createDataFrame(data, "doc_id int, text string"), "doc_id", "text")
    want = sorted((i, j) for i, a in data for j, b in data if i < j and a is not None and b is not None and a != b and textform.skeleton(a) == textform.skeleton(b))
    assert rows(lookalike.variant_pairs(hashed, floor=floor)) == sorted(want, key=repr)
    classes = {i: (c, n) for i, c, n in rows(lookalike.variant_members(hashed), "id", "class_id", "n_forms")}
    assert len(classes) == 90 and {n for _, n in classes.values()} <= {1, 2, 3}
    assert lookalike.variant_pairs(hashed.limit(0)).count() == 0


def test_canonical_text(spark):
    df = spark.createDataFrame([("ｅ́​",), (None,), ("",)], "text string")
    assert [x[0] for x in textform.canonical_text(df, "text", "form").select("form").collect()] == [unicodedata.normalize("NFC", "é"), None, ""]


def test_leaks_against_brute_force(spark):
    r = random.Random(7)
    vocab = [f"w{i}" for i in range(30)] + ["the"] * 20
    say = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(say(r.choice([5, 16, 40])))) for k in range(25)] + [(99, ""), (98, None)]
    docs = []
    for i in range(200):
        body = say(r.randrange(0, 60))
        if r.random() < 0.6:
            words = items[r.randrange(25)][1].split()
            a = r.randrange(len(words))
            body[r.randrange(len(body) + 1) : 0] = [w.upper() for w in words[a : a + r.randrange(4, 16)]]
        docs.append((i, r.choice([" ", " ", ", "]).join(body) if i % 40 else None))
    run = lambda ws, n: {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)}
    want = {(i, k) for i, t in docs for k, q in items if run(textform.words(t), 8) & run(textform.words(q), 8)}
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")
    for block in (8_000_000, 800):
        got = leakage.find_leaks(d, q, block_chars=block)
        assert set(rows(got.where("longest_run >= 8"), "doc_id", "item_id")) == want and len(want) > 20
    assert leakage.find_leaks(d, q.limit(0)).count() == leakage.find_leaks(d.limit(0), q).count() == 0


def test_edited_copy_is_aligned(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    copy = item.replace("zeta", "ZZZ").replace("kappa", "kappa extra")
    d = spark.createDataFrame([(1, f"some words before {copy} and after"), (2, "alpha beta gamma delta only")], "doc_id long, text string")
    got = leakage.find_leaks(d, spark.createDataFrame([(7, item)], "item_id int, text string")).collect()
    assert [r["doc_id"] for r in got] == [1] and got[0]["longest_run"] < 8
    assert len(got) == 1 and got[0]["share"] > 0.8


@pytest.mark.parametrize("verbatim", [1, 5])
def test_edited_copy_beside_verbatim_copies(spark, verbatim):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    copy = item.replace("zeta", "ZZZ").replace("kappa", "kappa extra")
    texts = [f"some words before {copy} and after", "alpha beta gamma delta only", *[item] * verbatim]
    got = leakage.find_leaks(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id int, text string")).collect()
    assert sorted(r["doc_id"] for r in got) == [0, *range(2, 2 + verbatim)]
    assert min(r["share"] for r in got) > 0.8


def test_leaks_are_those_of_aligning_all(spark):
    """Edits of any density, also where no four words in a row survive, in long and short documents."""
    r = random.Random(11)
    vocab = [f"w{i}" for i in range(60)] + ["the"] * 15 + ["of"] * 8
    say = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(k, say(r.choice([1, 2, 5, 9, 16, 30]))) for k in range(20)]
    docs = []
    for i in range(150):
        body = say(r.choice([0, 3, 30, 200]))
        copy = list(items[r.randrange(20)][1])
        step = r.choice([2, 3, 4, 6, 50])
        for at in range(len(copy) - 1, 0, -step):
            copy[at : at + r.randrange(2)] = say(r.randrange(3))
        body[r.randrange(len(body) + 1) : 0] = copy
        docs.append((i, body))
    want = {}
    for i, d in docs:
        for k, q in items:
            number = {w: x for x, w in enumerate(dict.fromkeys(q))}
            score, longest, _ = leakage.align(leakage.np.array([number.get(w, -1) for w in d], int), leakage.np.array([number[w] for w in q], int))
            if longest >= 8 or score >= len(q):
                want[(i, k)] = score
    d, q = (spark.createDataFrame([(i, " ".join(t)) for i, t in x], f"{name} long, text string") for x, name in ((docs, "doc_id"), (items, "item_id")))
    for block in (8_000_000, 400):
        got = leakage.find_leaks(d, q, block_chars=block).collect()
        assert {(r["doc_id"], r["item_id"]): r["score"] for r in got} == want and len(got) == len(want)
    assert any(r["n_seeds"] == 0 and r["share"] < 1 for r in got)
