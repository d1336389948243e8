import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from railpulse.llm import simhash
from tests.llm import cases


def plain_fingerprint(text, shingle=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    shingles = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(bits, ids, radius):
    root = list(range(len(bits)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(bits)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= radius:
                root[max(top(i), top(j))] = min(top(i), top(j))
    names = {}
    for i, k in enumerate(ids):
        if k is not None:
            names[top(i)] = min(k, names.get(top(i), k))
    return [names.get(top(i)) for i in range(len(bits))]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB \n\té日\x0b.İ"), max_size=80))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_many_words():
    text = " ".join(f"w{k % 700}" for k in range(3000))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_masks_lose_no_pair():
    masks = [m & (1 << 64) - 1 for m in simhash.block_masks()]
    source = np.random.default_rng(1)
    for _ in range(500):
        flips = sum(1 << int(b) for b in source.choice(64, simhash.RADIUS, replace=False))
        assert any(flips & m == 0 for m in masks)


def near_and_far(n, seed=2):
    """Random fingerprints with chains of near ones around some of them."""
    source = np.random.default_rng(seed)
    found = [int(x) for x in source.integers(0, 1 << 64, n, dtype=np.uint64)]
    for start in found[: n // 10]:
        at = start
        for _ in range(12):
            at ^= sum(1 << int(b) for b in source.choice(64, source.integers(1, 7), replace=False))
            found.append(at)
    return sorted(set(found))


def test_links_against_brute_force(spark):
    bits = near_and_far(300)
    rows = spark.createDataFrame([(int(np.array(b, np.uint64).view(np.int64)),) for b in bits], "bits long")
    want = plain_components(bits, list(range(len(bits))), 4)
    for block in (4096, 3):  # whole keys, and keys dealt out over pairs of blocks
        links = simhash.fingerprint_links(rows, block=block).collect()
        place = {int(np.array(b, np.uint64).view(np.int64)): k for k, b in enumerate(bits)}
        root = list(range(len(bits)))

        def top(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in {(place[r["a"]], place[r["b"]]) for r in links}:
            assert (bits[a] ^ bits[b]).bit_count() <= 4
            root[max(top(a), top(b))] = min(top(a), top(b))
        assert [top(i) for i in range(len(bits))] == want


def test_dense_group_leaves_a_forest(spark):
    group = [1 << a | 1 << b for a in range(20) for b in range(a)]  # all within four bits of each other
    rows = spark.createDataFrame([(b,) for b in group], "bits long")
    links = simhash.fingerprint_links(rows).collect()
    assert len(links) < len(group) * len(simhash.block_masks())


def test_unusual_rows(spark):
    for docs in (cases.unusual(spark, clashing=True), cases.unusual(spark)):
        rows = simhash.near_duplicates(docs).collect()
        bits = [plain_fingerprint(t) for t in cases.texts()]
        want = plain_components(bits, [r[0] for r in cases.ROWS], 4)
        expected = sorted(str((r[0], b, c)) for r, b, c in zip(cases.ROWS, bits, want))
        assert sorted(str((r["doc_id"], r["bits"] % (1 << 64), r["component_id"])) for r in rows) == expected
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0


def edited(words, share, source):
    out = list(words)
    for at in source.choice(len(words), round(share * len(words)), replace=False):
        out[at] = f"new{source.integers(1 << 40)}"
    return " ".join(out)


def jaccard(a, b, shingle=5):
    sets = [{tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)} for w in (a.split(), b.split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_similar_documents(spark):
    source = np.random.default_rng(4)
    texts = [" ".join(f"w{source.zipf(1.3) % 20_000}" for _ in range(source.integers(150, 900))) for _ in range(250)]
    pairs = []
    for k in range(120):
        texts.append(edited(texts[k].split(), source.choice([0.003, 0.01, 0.018, 0.3]), source))
        pairs.append((k, len(texts) - 1, jaccard(texts[k], texts[-1])))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    component = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(docs).collect()}
    component.update({b: a for a, b, j in pairs if b not in component and j == 1})  # a copy joins its first
    alike = [component[a] == component[b] for a, b, j in pairs if j >= 0.82]
    apart = [component[a] == component[b] for a, b, j in pairs if j < 0.5]
    assert len(alike) > 40 and sum(alike) >= 0.97 * len(alike) and not any(apart)
    assert all(component[k] == k for k in range(250))
    kept = {r["doc_id"] for r in simhash.first_of_each(docs).collect()}
    assert kept == {k for k, c in component.items() if k == c}


def test_passages_added_and_removed_meet_at_the_promised_rate():
    """Pairs just above 0.8 by one contiguous edit; the rate can't depend on the number of texts."""
    source, number = np.random.default_rng(9), simhash.number_of_keys(0.8)
    met = []
    for k in range(1500):
        words = [f"w{source.integers(1 << 30)}" for _ in range(260)]
        other = [*words, *[f"w{source.integers(1 << 30)}" for _ in range(62)]] if k % 2 else [*words[:90], *words[134:]]
        assert 0.8 <= jaccard(" ".join(words), " ".join(other)) < 0.82
        a, b = (simhash.minima_keys(np.unique(simhash.shingle_hashes(" ".join(t), 5, 42)[0]), number)
                for t in (words, other))
        met.append(any(x == y for x, y in zip(a, b)))
    assert np.mean(met) >= 0.985


def test_texts_with_an_added_passage_link(spark):
    source = np.random.default_rng(10)
    texts = [" ".join(f"w{source.integers(20_000)}" for _ in range(300)) for _ in range(80)]
    texts += [t + "".join(f" w{source.integers(20_000)}" for _ in range(66)) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    component = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(docs).collect()}
    assert sum(component[k + 80] == k for k in range(80)) >= 78


def test_repeats_of_a_line_count_once(spark):
    source = np.random.default_rng(11)
    words = [f"w{source.integers(20_000)}" for _ in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, *(["again and again the same line"] * 500)])),
            (3, " ".join([*reversed(words), *(["again and again the same line"] * 500)]))]
    found = simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == [(1, 1), (2, 1), (3, 3)]


def test_texts_below_the_similarity_stay_apart(spark):
    source = np.random.default_rng(7)
    texts = [" ".join(f"w{source.integers(20_000)}" for _ in range(300)) for _ in range(60)]
    pairs = []
    for k in range(60):
        texts.append(edited(texts[k].split(), source.choice([0.026, 0.034, 0.045]), source))
        pairs.append((k, len(texts) - 1, jaccard(texts[k], texts[-1])))
    below = {k for a, b, j in pairs if j < 0.8 for k in (a, b)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    component = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(docs).collect()}
    assert sum(0.7 < j < 0.8 for _, _, j in pairs) > 20
    assert all(component[k] == k for k in below)


def test_dense_group_is_verified_whole(spark):
    """Copies of a text that are alike only by way of it: none is lost, and few pairs leave the keys."""
    source = np.random.default_rng(8)
    first = [f"w{source.integers(20_000)}" for _ in range(400)]
    texts = [" ".join(first), *[edited(first, 0.0175, source) for _ in range(40)]]
    want = [jaccard(texts[0], t) >= 0.8 for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = simhash.similar_documents(docs).collect()
    assert sum(want) > 30 and all(r["component_id"] == 0 for r in found if want[r["doc_id"]])


def test_first_of_each_of_unusual_rows(spark):
    kept = simhash.first_of_each(cases.unusual(spark)).collect()
    # 1 and 6 are copies; 2 and 3 have no words; the row without an id stays.
    assert sorted(str(r["doc_id"]) for r in kept) == ["-4", "1", "2", "5", "7", "9", "None"]
    assert simhash.first_of_each(cases.empty(spark)).count() == 0


def template_group(source, members, share, words=300):
    """Texts of one template, each with its own words at some places; their similarities."""
    first = [f"w{source.integers(20_000)}" for _ in range(words)]
    return [edited(first, share, source) for _ in range(members)]


def made(spark, monkeypatch, texts):
    """Components, and how many rows each table of pairs had."""
    rows, plain = {}, simhash.stored

    def counted(df, purpose):
        out = plain(df, purpose)
        if purpose in ("candidates", "verified"):
            rows.setdefault(purpose, []).append(out.count())
        return out

    monkeypatch.setattr(simhash, "stored", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(docs).collect()}
    monkeypatch.setattr(simhash, "stored", plain)
    return found, rows


def test_pairs_grow_with_a_group_and_not_with_its_square(spark, monkeypatch):
    monkeypatch.setattr(simhash, "FINE_BLOCK", 64)  # so that keys are dealt over several blocks
    total = {}
    for members in (200, 400):
        texts = template_group(np.random.default_rng(5), members, 0.01)
        found, rows = made(spark, monkeypatch, texts)
        assert set(found.values()) == {0}
        total[members] = sum(rows["candidates"]) + sum(rows["verified"])
    assert total[400] < 2.5 * total[200] and total[400] < 2 * 14 * 400


def test_a_template_below_the_similarity_makes_few_pairs(spark, monkeypatch):
    """Of all pairs of texts of one template, no more than a few a text and key leave the tasks."""
    texts = template_group(np.random.default_rng(6), 300, 0.018)
    alike = [jaccard(a, b) for i, a in enumerate(texts) for b in texts[:i]]
    assert 0.66 < np.mean(alike) < 0.74
    found, rows = made(spark, monkeypatch, texts)
    assert found == brute_components(texts)
    assert sum(rows["candidates"]) < 14 * 2 * 300 and rows["verified"][2] < 14 * 300


def brute_components(texts, similarity=0.8):
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    least = list(range(len(texts)))

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both >= similarity * (len(a) + len(sets[j]) - both):
                x, y = top(i), top(j)
                least[max(x, y)] = min(x, y)
    return {i: top(i) for i in range(len(texts))}


def test_pivots_discard_pairs_in_every_key():
    prints = np.random.default_rng(2).integers(0, 1 << 64, (400, 1), dtype=np.uint64)
    met = []
    plain, pivots = simhash.distances, simhash.reference_fingerprints()

    class Counting:
        @staticmethod
        def distances(one, others):
            if others.shape == (len(others), 1) and one.shape == (1,):
                met.append(len(others))
            return plain(one, others)

    simhash.distances = Counting.distances
    try:
        assert simhash.links_within(prints, pivots, 4) == []
    finally:
        simhash.distances = plain
    assert sum(met) < 400 * 399 / 2 / 1000  # pairs that the table leaves to verify
