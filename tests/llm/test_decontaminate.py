import random
import re

import pyarrow as pa
import pytest

from tallygrid.llm.decontaminate import leaks, templates

RNG = random.Random(6)
VOCABULARY = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]


def sentence(n):
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


def found(docs, spark, rows, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, int(r.item_id)) for r in leaks(docs(rows), bench, **options).collect()}


QUESTION = "a train with Anna drives 120 km to see Anna and Tom for 45 minutes while the 120 boxes of Tom weigh about 30 kg in the old yard"


def test_whole_items_partial_items_and_clean_texts(docs, spark):
    items = [(1, sentence(40)), (2, sentence(30)), (3, "short item here"), (4, None), (5, ""), (None, sentence(20))]
    half = " ".join(items[0][1].split()[10:32])
    rows = [
        (10, sentence(50) + " " + items[0][1] + " " + sentence(50)),
        (11, items[1][1].upper().replace(" ", "!! ") + "!!"),
        (12, f"{sentence(9)} {half} {sentence(9)}"),
        (13, f"so this short, item here {sentence(5)}"),
        (14, sentence(300)),
        (15, None),
        (16, ""),
        (None, items[0][1]),
        (17, " ".join(items[1][1].split()[:9])),
    ]
    assert found(docs, spark, rows, items) == {(10, 1), (11, 2), (12, 1), (13, 3), (None, 1)}
    assert found(docs, spark, [], items) == set() and found(docs, spark, rows, []) == set()


def test_reparameterised_questions_have_consistent_slots(docs, spark):
    values = {"Anna": "Lena", "Tom": "Ravi", "120": "75", "45": "20", "30": "9"}
    changed = re.sub("|".join(values), lambda m: values[m[0]], QUESTION)
    # The same words, but each slot another value at each place.
    n = iter(range(1000, 2000))
    torn = re.sub("|".join(values), lambda m: f"N{next(n)}x" if m[0][0].isalpha() else str(next(n)), QUESTION).replace("N1", "Na1")
    rows = [(1, f"{sentence(30)} {changed} {sentence(20)}"), (2, QUESTION), (2, QUESTION), (3, torn)]
    assert found(docs, spark, rows, [(7, QUESTION)], share=0.8, run=100) == {(1, 7), (2, 7)}


def test_dense_slots_and_names_that_open_sentences(docs, spark):
    items = [(1, "Compute 12 + 7 * 3 - 4 now"), (2, "Tom has 5 apples. Anna has 7 pears. How many do Tom and Anna have together?")]
    items += [(3, "1 2 3 4 5 6 7 8 9"), (4, "The yard of the old house has a gate. It is green, and it is never closed at night.")]
    rows = [(1, f"{sentence(9)} compute 31 + 8 * 2 - 5 now {sentence(9)}"), (2, f"{sentence(9)}. Ravi has 8 apples. Lena has 3 pears. How many do Ravi and Lena have together? {sentence(9)}")]
    rows += [(7, "We know that Ravi has 8 apples. Lena has 3 pears. How many do Ravi and Lena have together?")]
    # Other names at each place; a table of other numbers; openings in another case; the openings of both sentences changed.
    rows += [(3, "Ravi has 8 apples. Lena has 3 pears. How many do Nora and Finn have together?"), (4, "9 8 7 6 5 4 3 2 1"), (5, items[3][1].lower()), (6, items[3][1].replace("The", "Our"))]
    got = found(docs, spark, rows, items)
    assert {(1, 1), (2, 2), (7, 2), (5, 4), (6, 4)} <= got and not {d for d, _ in got} & {4}
    assert (3, 2) not in found(docs, spark, rows, items, share=0.8, run=100)


def plain_templates(text):
    """Words of simple texts as (kind or word, value), as they are and with openings as names."""
    out, opening = [], True
    for word in text.split():
        bare = word.strip(".?,+*-")
        if bare:
            kind = "#" if bare[0].isdigit() else "N" if bare[0].isupper() and not opening else bare.lower()
            out.append((kind, "N" if bare[0].isupper() else kind, bare.lower()))
        opening = word[-1] in ".?"
    return out


def test_slot_check_against_plain_search(docs, spark):
    from collections import Counter

    rng = random.Random(11)
    people, nouns = ["Tom", "Anna", "Ravi", "Lena"], ["apples", "pears", "boxes"]

    def question():
        a, b = rng.sample(people, 2)
        x, y = rng.randrange(2, 30), rng.randrange(2, 30)
        return f"{a} has {x} {rng.choice(nouns)}. {b} has {y} {rng.choice(nouns)}. When {a} gives {rng.randrange(2, 9)} to {b}, how many does {rng.choice([a, b])} have?"

    items = [(i, question()) for i in range(12)]
    rows = [(i, f"so it went. {question()} and {rng.choice(items)[1]}") for i in range(25)]
    want = set()
    for d, text in rows:
        for j, item in items:
            words, own = plain_templates(text), plain_templates(item)
            hits, votes = [], Counter()
            for kind in (0, 1):
                for p in range(len(own) - 7):
                    for q in range(len(words) - 7):
                        x, y = own[p : p + 8], words[q : q + 8]
                        if [w[kind] for w in x] == [w[kind] for w in y] and (not kind or "N" in [w[1] for w in x]):
                            pairs = [(u[2], v[2]) for u, v in zip(x, y) if u[kind] in "#N"]
                            hits.append((p, q, pairs))
                            votes.update(pairs)
            to_doc, to_item = {}, {}
            for (u, v), n in votes.items():
                to_doc.setdefault(u, []).append((n, v))
                to_item.setdefault(v, []).append((n, u))
            tie = any(sorted(n for n, _ in x)[-2:] == [max(x)[0]] * 2 for side in (to_doc, to_item) for x in side.values() if len(x) > 1)
            agreed = {(u, max(x)[1]) for u, x in to_doc.items()} & {(max(x)[1], v) for v, x in to_item.items()}
            good = [(p, q) for p, q, pairs in hits if set(pairs) <= agreed]
            line = Counter(q - p for p, q in set(good))
            if len({p for p, _ in good}) >= 0.5 * (len(own) - 7) or (line and max(line.values()) + 7 >= 13):
                want.add((d, j, tie))
            elif tie:
                want.add((d, j, None))
    got = found(docs, spark, rows, items)
    # Pairs with tied votes are decided by hashes, which this search does not know.
    open_ = {(d, j) for d, j, tie in want if tie is not False}
    assert got - open_ == {(d, j) for d, j, tie in want if tie is False} and len(got - open_) > 25


def test_templates_by_words():
    rows, template, value, slot, may = templates(pa.array(["The cat met Tom. Then 5 kg, $7 *** km TOM x", None, "", "É tom"]))
    assert rows.tolist() == [0] * 11 + [3] * 2
    assert [k for k, x in enumerate(slot) if x] == [3, 5, 6, 7, 8]
    assert [k for k, x in enumerate(may) if x] == [0, 4]
    assert template[5] == template[7] and value[5] != value[7]
    assert value[3] == value[9] == value[-1]  # Tom, TOM and tom


@pytest.mark.parametrize("window", [5, 8])
def test_against_plain_search(docs, spark, window):
    items = [(i, sentence(RNG.choice([3, 12, 25]))) for i in range(8)]
    rows = []
    for i in range(60):
        parts = [sentence(RNG.randrange(1, 30)), RNG.choice(items)[1] if RNG.random() < 0.4 else "", sentence(RNG.randrange(1, 30))]
        rows.append((i, " ".join(parts)))
    want = set()
    for i, text in rows:
        for j, item in items:
            words, own = text.split(), item.split()
            size = min(window, len(own))
            have = {tuple(words[a : a + size]) for a in range(len(words) - size + 1)}
            wins = [tuple(own[a : a + size]) for a in range(len(own) - size + 1)]
            hits = [w in have for w in wins]
            if sum(hits) >= 0.5 * len(wins):
                want.add((i, j))
    assert found(docs, spark, rows, items, window=window) == want
