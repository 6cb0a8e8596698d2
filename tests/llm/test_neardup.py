import random

from hypothesis import given, settings
from hypothesis import strategies as st

from spanloom.llm import common, neardup, ordersketch as o
from tests.llm import odd


def shingles(text):
    return o.Shingles(o.shingle_hashes(o.words_of(text)).tobytes())


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        before = row[:]
        for j, b in enumerate(y):
            row[j + 1] = before[j] + 1 if a == b else max(before[j + 1], row[j])
    return row[-1]


def ordered(a, b):
    x, y = shingles(a).items, shingles(b).items
    common_ = lcs(x, y)
    return common_ / (len(x) + len(y) - common_)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=40), st.lists(st.tuples(st.integers(0, 40), st.sampled_from("abcd")), max_size=5), st.booleans())
def test_banded_alignment_is_exact_from_the_threshold_on(words, edits, shorter):
    other = list(words)
    for at, word in edits:
        other[at % len(other)] = word
    if shorter and len(other) > 1:
        del other[len(other) // 2]
    a, b = " ".join(words), " ".join(other)
    true, got = ordered(a, b), o.aligned(shingles(a), shingles(b))
    assert (got >= o.SIMILARITY) == (true >= o.SIMILARITY)
    if true >= o.SIMILARITY:
        assert abs(got - true) < 1e-12


def test_sketch_keeps_order():
    words = [f"w{i}" for i in range(200)]
    turned = words[100:] + words[:100]
    same = lambda a, b: (o.band_keys(a) == o.band_keys(b)).sum()
    assert same(words, list(words)) == o.BANDS
    assert same(words, [*words[:50], "x", *words[51:]]) > 0
    assert same(words, turned) < o.BANDS
    assert len(o.band_keys(["one"])) == len(o.band_keys(["a"] * 1000)) == o.BANDS


def test_occurrences_are_labelled_apart():
    hashes = o.shingle_hashes(["a"] * 9)
    assert len(set(hashes.tolist())) == 1 and len(set(o.labelled(hashes).tolist())) == len(hashes) == 5


def classes_by_force(rows):
    """Components of all links between different texts, found by comparing every pair."""
    texts = sorted({t for _, t in rows if t})
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    held = {t: shingles(t) for t in texts if o.words_of(t)}
    for i, a in enumerate(texts):
        for b in texts[i + 1 :]:
            if a in held and b in held and min(len(held[a].items), len(held[b].items)) >= 0.8 * max(len(held[a].items), len(held[b].items)) and o.aligned(held[a], held[b]) >= o.SIMILARITY:
                parent[find(a)] = find(b)
    ids = {}
    for i, t in rows:
        if t and i is not None:
            ids[find(t)] = min(i, ids.get(find(t), i))
    return sorted(((i, ids.get(find(t)) if t else i) for i, t in rows), key=str)


def corpus(seed=0):
    """Exact and near copies in groups of two to dozens, chains, and texts that share passages."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage = " ".join(word() for _ in range(60))
    rows = []
    for size, edits in ((2, 1), (3, 2), (40, 2), (30, 5), (25, 8), (5, 0), (12, 12)):
        base = [word() for _ in range(160)]
        for _ in range(size):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    chain = [word() for _ in range(150)]
    for step in range(12):  # neighbours are alike, the ends are not
        chain = list(chain)
        chain[(step * 12) % 150] = word()
        rows.append(" ".join(chain))
    rows += [passage + " " + " ".join(word() for _ in range(30)) for _ in range(25)]
    rows += [" ".join(word() for _ in range(rng.randint(1, 9))) for _ in range(20)]
    rng.shuffle(rows)
    return list(enumerate(rows, 1000))


def test_classes_against_brute_force(spark):
    rows = [*[(r[0], r[1]) for r in odd.ROWS], *corpus()]
    frame = odd.clashing(spark.createDataFrame(rows, "doc_id long, text string"), "node", "label", "class_id", "keys")
    got = sorted(((r.doc_id, r.class_id) for r in neardup.near_duplicates(frame).collect()), key=str)
    assert got == classes_by_force(rows)


def test_components_by_one_task_and_by_rounds(spark, monkeypatch):
    rng = random.Random(3)
    name = lambda i: bytes([i // 256, i % 256])
    pairs = [(i, i + 1) for i in range(300, 340)] + [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(400, i) for i in range(401, 450)]
    links = spark.createDataFrame([(name(a), name(b)) for a, b in pairs if a != b], "a binary, b binary")
    found = []
    for limit in (neardup.MAX_ONE_TASK_LINKS, 0):
        monkeypatch.setattr(neardup, "MAX_ONE_TASK_LINKS", limit)
        found.append(sorted((bytes(r.node), bytes(r.label)) for r in neardup.components(links).collect()))
    assert found[0] == found[1] and len({label for _, label in found[0]}) < len(found[0]) / 2
    assert all(label <= node for node, label in found[0])


def test_long_words_differ_by_the_order_of_their_bytes():
    a, b = "x" * 100 + "ab", "x" * 100 + "ba"
    assert len(set(o.word_hashes([a, b, a]).tolist())) == 2


def test_empty(spark):
    assert neardup.near_duplicates(odd.empty(spark)).count() == 0
    assert neardup.deduplicate(odd.empty(spark)).count() == 0


def test_one_of_each_class_stays(spark, monkeypatch):
    rows = [*[(r[0], r[1]) for r in odd.ROWS], *corpus(1), (50, "the very same text as another"), (50, "the very same text as another"), (51, "the very same text as another")]
    frame = odd.clashing(spark.createDataFrame(rows, "doc_id long, text string"), "node", "number", "class_node", "stays")
    by_class = {}
    for i, c in classes_by_force([row for row in rows if row[1]]):
        by_class.setdefault(c, set()).add(i)
    for limit in (neardup.MAX_BROADCAST_ROWS, 0):
        monkeypatch.setattr(neardup, "MAX_BROADCAST_ROWS", limit)
        kept = neardup.deduplicate(frame)
        assert kept.columns == frame.columns
        found = [(r.doc_id, r.text) for r in kept.collect()]
        full = [i for i, t in found if t]
        assert sorted(full, key=str) == sorted(by_class, key=str) and len(full) == len(set(full))
        assert sum(not t for _, t in found) == sum(not t for _, t in rows)


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in common.table(spark, sf, "documents").collect()]
    got = sorted(((r.doc_id, r.class_id) for r in neardup.op6_near_duplicates(spark, sf).collect()), key=str)
    assert got == classes_by_force(rows)
