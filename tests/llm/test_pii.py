import random
import re

from tallygrid.llm.pii import KINDS, _shaped, base_spans, find_personal_data, span_digests


def luhn(digits):
    return sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def named(text):
    return [(KINDS[k], a, b) for k, a, b in base_spans(text)]


def test_base_formats_against_the_patterns():
    rng = random.Random(1)
    parts = ["1", "22", "255", "256", ".", "..", "@", "a.b", "x@y.z", "-", "+", "(", ")", " ", "4111111111111111", "4111-1111 1111-1111", "é", "+1 (555) 123-4567", "\n"]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert named(text) == plain(text), repr(text)


def test_long_runs_end_soon():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@a" * 100_000, "a." * 100_000 + "@", "+1" + "(" * 200_000):
        named(text)


def test_context_finds_unseen_identifiers(docs):
    rng = random.Random(2)
    filler = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"]

    def prose(n):
        return " ".join(rng.choice(filler) for _ in range(n))

    rows = [(i, f"{prose(5)} please call me at +1 (555) 12{i:02d}-4567 any day {prose(5)}") for i in range(20)]
    rows += [(100, f"{prose(4)} please call me at 555-987-6543 any day {prose(4)}"), (101, f"{prose(6)} order 555-987-1111 was {prose(6)}")]
    rows += [(102, None), (103, ""), (None, "mail x@y.org")]
    out = {r.doc_id: r for r in find_personal_data(docs(rows)).collect()}
    text = rows[20][1]
    at = text.index("555-987-6543")
    assert [tuple(s) for s in out[100].added] == [(3, at, at + 12)] and out[100].base == []
    assert out[101].added == out[102].added == out[103].added == []
    assert all(len(out[i].base) == 1 and out[i].added == [] for i in range(20))
    digests = {r.doc_id: r for r in span_digests(find_personal_data(docs(rows))).collect()}
    assert digests[100].spans == f"phone:{at}:{at + 12}" and digests[100].n_phone == 0
    assert digests[None].spans == "email:5:12" and digests[None].n_email == 1


def test_groups_of_digits_and_words_like_addresses(docs):
    filler = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = [(i, f"{filler[i]} please call me at +1 (555) 12{i:02d}-4567 any day {filler[-i]}") for i in range(20)]
    rows += [(50 + i, f"{filler[i]} write a note to user{i}@mail.example.org before the end {filler[-i]}") for i in range(20)]
    rows += [(100, "so please call me at 020 7946 0018 any day"), (101, "please call me at (020) 7946 0018, any day"), (102, "write a note to jane(at)example before the end"), (103, "write a note to root@localhost before the end"), (104, "a table 1 22 333 4444 55555 666666 7777777 has rows")]
    texts = dict(rows)
    out = {r.doc_id: [(KINDS[k], texts[r.doc_id][a:b]) for k, a, b in r.added] for r in find_personal_data(docs(rows)).collect()}
    assert out[100] == [("phone", "020 7946 0018")] and out[101] == [("phone", "(020) 7946 0018")]
    assert out[102] == [("email", "jane(at)example")] and out[103] == [("email", "root@localhost")]
    assert not any(out[i] for i in [*range(20), *range(50, 70), 104])
    shapes = [text[a:b] for text in ["tel 12 34, 56 78. (1) 2-3 x9 9\t8", "", "1 22 333 4444 55555 666666"] for a, b in _shaped(text, [m.span() for m in re.finditer("[^ \t]+", text)])]
    assert shapes == ["12 34", "56 78", "(1) 2-3", "x9", "9", "8", "1", "22", "333", "4444", "55555", "666666"]


def test_repeated_rows_and_empty_tables(docs):
    twice = find_personal_data(docs([(1, "1.2.3.4"), (1, "1.2.3.4"), (1, "x")])).collect()
    assert sorted(len(r.base) for r in twice) == [0, 1, 1]
    assert find_personal_data(docs([])).collect() == []
