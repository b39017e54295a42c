import random
from itertools import combinations

from tillwright.llm import decontamination as dec

WORDS = [f"w{i}" for i in range(3000)]


def words(dice, n):
    return [dice.choice(WORDS) for _ in range(n)]


def plain(docs, items, window=20, least=0.8):
    """Pairs that overlap, by sliding every item over every document."""
    found = set()
    for d, text in docs:
        own = dec.words_of(text)
        for i, item in items:
            want = dec.words_of(item)
            if not want:
                continue
            size = min(window, len(want))
            for shift in range(-len(want), len(own)):
                equal = [0 <= shift + q < len(own) and own[shift + q] == w for q, w in enumerate(want)]
                if any(sum(equal[q:q + size]) >= dec.needed(size, least) for q in range(len(want) - size + 1)):
                    found.add((d, i))
                    break
    return found


def corpus():
    dice = random.Random(1)
    items = [(i, " ".join(words(dice, n))) for i, n in enumerate((60, 25, 20, 19, 12, 7, 4, 1, 30))]
    items += [(100, None), (101, "  \n"), (102, "... !!"), (None, " ".join(words(dice, 24)))]
    docs = [(-1, None), (-2, ""), (-3, "w1"), (None, items[0][1]), (7, items[1][1]), (7, items[1][1])]
    for _ in range(60):
        _, text = dice.choice([i for i in items if i[1] and dec.words_of(i[1])])
        own = dec.words_of(text)
        for at in dice.sample(range(len(own)), dice.randint(0, len(own) // 3)):
            own[at] = dice.choice(WORDS)
        cut = dice.randint(0, len(own) // 2) if dice.random() < 0.4 else 0
        docs.append((1000 + len(docs), " ".join(words(dice, dice.randint(0, 40)) + own[cut:] + words(dice, dice.randint(0, 40)))))
    docs.append((900, " ".join(words(dice, 20_000)) + ", " + items[2][1].upper()))
    return docs, items


def test_pairs_against_brute_force(spark, clashing):
    docs, items = corpus()
    known = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    for block_words in (500_000, 40):
        found = dec.find_overlaps(clashing(docs), known, block_words=block_words).collect()
        assert {(r.doc_id, r.item_id) for r in found} == plain(docs, items)
        assert all(r.overlap >= 0.5 and r.matched <= r.compared == r.stop - r.start for r in found)


def test_decontaminate_drops_them_only(spark, clashing):
    docs, items = corpus()
    known = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    bad = {d for d, _ in plain(docs, items)}
    df = clashing(docs)
    left = dec.decontaminate(df, known, block_words=60)
    assert left.columns == df.columns
    assert sorted((r[0] for r in left.collect()), key=str) == sorted((d for d, _ in docs if d not in bad), key=str)


def test_masks_find_every_four_substitutions_in_twenty():
    for places in combinations(range(20), 4):
        hit = any(
            all(at + i not in places for i, use in enumerate(mask) if use == "1")
            for mask in dec.MASKS for at in range(20 - len(mask) + 1)
        )
        assert hit, places


def test_masks_of_short_items_find_every_tolerated_overlap():
    for size in range(1, 20):
        (mask,) = dec.masks_for(size, 20, 0.8)
        for n in range(size - dec.needed(size, 0.8) + 1):
            for places in combinations(range(size), n):
                assert any(not set(range(at, at + len(mask))) & set(places) for at in range(size - len(mask) + 1))


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id BIGINT, text STRING")
    one = spark.createDataFrame([(1, "a b c")], "item_id BIGINT, text STRING")
    assert dec.find_overlaps(docs([(1, "a b c")]), none).collect() == []
    assert dec.find_overlaps(docs([]), one).collect() == []
    assert dec.decontaminate(docs([(1, "a b c")]), none).count() == 1
    assert dec.decontaminate(docs([]), one).count() == 0


def test_repeated_words_in_item_and_text():
    import time
    import tracemalloc

    items = [(1, ["so"] * 60), (2, ["so", "on"] * 30), (3, ["other"] * 5 + ["so"] * 20)]
    block = dec.Block(items, 20, 0.8)
    tracemalloc.start()
    began = time.time()
    found = block.overlaps("so " * 400_000)
    took, peak = time.time() - began, tracemalloc.get_traced_memory()[1]
    assert found[0] == (0, 60, 60, 60)
    assert set(found) == {0, 2} and found[2][2] == 20
    assert took < 20 and peak < 200 << 20, (took, peak)
    print("seconds and MB", took, peak / 2**20)
    assert block.overlaps("so on " * 20_000)[1] == (0, 60, 60, 60)


def test_best_stretch_against_every_diagonal(monkeypatch):
    """Small alphabets, so that hits repeat; the seeds of a 20-word item find all tolerated overlaps."""
    monkeypatch.setattr(dec, "HITS", 7)
    monkeypatch.setattr(dec, "CELLS", 50)
    dice = random.Random(3)
    for _ in range(150):
        letters = "ab" if dice.random() < 0.5 else "abcdef"
        items = [(i, [dice.choice(letters) for _ in range(dice.randint(1, 30))]) for i in range(3)]
        text = [dice.choice(letters + "z") for _ in range(dice.randint(0, 60))]
        found = dec.Block(items, 20, 0.8).overlaps(" ".join(text))
        for row, (_, item) in enumerate(items):
            size, best = min(20, len(item)), None
            for shift in range(-len(item) + 1, len(text)):
                equal = [0 <= shift + q < len(text) and text[shift + q] == w for q, w in enumerate(item)]
                good = [q for q in range(len(item) - size + 1) if sum(equal[q:q + size]) >= dec.needed(size, 0.8)]
                if good:
                    a, b = max(0, -shift, good[0]), min(len(item), len(text) - shift, good[-1] + size)
                    one = (shift + a, shift + b, sum(equal[a:b]), b - a)
                    if best is None or (-one[2], one[0]) < (-best[2], best[0]):
                        best = one
            assert found.get(row) == best, (item, text)
