import random

from corpusflow.llm.decontaminate import Items, edits_within, find_leaks
from corpusflow.llm.language_id import letter_words
from tests.llm.helpers import invented


def _edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        p = rng.randrange(len(words))
        rng.choice([lambda: words.__setitem__(p, invented(rng, 1)), lambda: words.pop(p), lambda: words.insert(p, invented(rng, 1))])()
    return words


def test_edit_distance_to_the_best_part():
    def brute(item, text):
        row = [0] * (len(text) + 1)
        for i, x in enumerate(item, 1):
            new = [i]
            for j, y in enumerate(text, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
            row = new
        return min(row)

    rng = random.Random(1)
    for _ in range(200):
        item, text = (letter_words([" ".join(rng.choices("abcd", k=rng.randint(1, 12)))]).key for _ in range(2))
        assert edits_within(item, text) == brute(item.tolist(), text.tolist())


def test_recall_within_the_bound_and_nothing_else():
    rng = random.Random(2)
    items = [(i, invented(rng, rng.randint(8, 60))) for i in range(120)]
    built = Items.build(items, 0.2, 8)
    found = total = 0
    for i, text in items:
        words = text.split()
        held = " ".join([invented(rng, 50), *_edited(rng, words, int(len(words) * 0.2)), invented(rng, 50)])
        got = dict(built.find([held])[0])
        total += 1
        found += i in got
        # Whatever is reported is within its bound by exact edit distance.
        for j, edits in got.items():
            own = letter_words([items[j][1]]).key
            assert edits == edits_within(own, letter_words([held]).key) <= int(len(own) * 0.2)
    assert found / total >= 0.97
    clean = [invented(rng, 300) for _ in range(50)]
    assert not any(built.find(clean))


def test_exact_items_wherever_they_stand():
    rng = random.Random(3)
    items = [(i, invented(rng, n)) for i, n in enumerate([8, 9, 15, 40, 200])]
    built = Items.build(items, 0.2, 8)
    for i, text in items:
        shout = text.upper().replace(" ", " -- ")
        for held in (text, f"{text} end", f"begin {text}", f"x {shout}! y", f"{text} {text}"):
            assert (i, 0) in built.find([held, "other"])[0]
        cut = " ".join(text.split()[:-1])
        assert (i, 1) in built.find([cut])[0]


def test_odd_rows_and_blocks(spark, monkeypatch):
    rng = random.Random(4)
    items = [(i, invented(rng, 20)) for i in range(12)] + [(50, None), (51, "too short"), (None, invented(rng, 20))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1, items[3][1], 0), (2, None, 0), (3, "", 0), (4, f"{items[5][1]}\n{items[3][1]}", 0), (4, f"{items[5][1]}\n{items[3][1]}", 0), (6, "too short", 0), (7, items[14][1], 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, leaks int").repartition(2)
    want = sorted([(1, [(3, 0)]), (2, []), (3, []), (4, [(3, 0), (5, 0)]), (4, [(3, 0), (5, 0)]), (6, []), (7, [(None, 0)])])
    for block in (16 << 20, 200):
        monkeypatch.setattr("corpusflow.llm.decontaminate.BLOCK_BYTES", block)
        got = sorted((r["doc_id"], [tuple(x) for x in r["leaks"]]) for r in find_leaks(df, bench).collect())
        assert got == want
    assert all(r["leaks"] == [] for r in find_leaks(df, bench.limit(0)).collect())
    assert find_leaks(df.limit(0), bench).count() == 0


def test_short_items_digits_and_scripts_without_spaces(spark):
    items = [(1, "What is 12 + 7?"), (2, "日本の首都はどこですか。東京です。"), (3, "Too short"), (4, "東京は?"), (5, "..."), (6, "too, SHORT"), (7, "12 7 5 31 44 9 10 2")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [
        (1, "so: what is 12 + 7 then"), (2, "what is 13 + 7"), (3, "今日は日本の首都はどこですか東京ですと言う"), (4, "much too short, too short"), (5, "too"),
        (6, "short"), (7, "東京は広い"), (8, None), (9, ""), (10, "x12 7 5 31 44 9 10 2"), (11, "12 7 6 30 43 9 10 2"), (12, "what is"), (13, "12 7"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    want = {1: [(1, 0)], 3: [(2, 0)], 4: [(3, 0), (6, 0)], 7: [(4, 0)], 10: [(7, 0)]}
    got = {r["doc_id"]: [tuple(x) for x in r["leaks"]] for r in find_leaks(df, bench, short_items=True).collect()}
    assert got == {i: want.get(i, []) for i, _ in docs}
    only = find_leaks(df, bench.where("item_id = 4"), short_items=True)
    assert [r["doc_id"] for r in only.where("size(leaks) > 0").collect()] == [7]
