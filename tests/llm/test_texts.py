"""Personal data, decontamination and quotation linking."""

import hashlib
import random
import re

import numpy as np
import pytest

from millrace.llm import decontaminate, pii, quotes
from tests.llm.helpers import documents, odd
from tests.llm.test_measures import prose


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute_base(text):
    out = []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    r, p = random.Random(3), pii._patterns()
    for _ in range(20_000):
        text = "".join(r.choice("a1@.+- (9)_\n5x0é") for _ in range(r.randrange(40)))
        assert pii.base_spans(text, p) == brute_base(text), text


def test_pii_query(spark):
    texts = [
        "mail und.34@mail7.example.com, und.34 said; card 4111 1111 1111 1111, again 4111.1111.1111.1111",
        "call +1 (017) 555-7713 or (017) 555-7713 from 10.0.0.1, not 300.1.1.1 or 4111 1111 1111 1112", prose(1, 50), None]
    rows = pii.query(spark, documents(spark, *texts)).orderBy("doc_id").collect()
    for r, text in zip(rows, texts):
        base = brute_base(text or "")
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == i for s in base) for i in range(4)]
        assert set(joined.split(",")) <= set(r["spans"].split(","))
    said = lambda r, t: [t[int(a) : int(b)] for _, a, b in (s.split(":") for s in r["spans"].split(","))]
    assert {"und.34", "4111.1111.1111.1111"} <= set(said(rows[0], texts[0]))
    assert "(017) 555-7713" in said(rows[1], texts[1])
    assert not any("4111" in s or "300" in s for s in said(rows[1], texts[1]))
    assert rows[2]["spans"] == rows[3]["spans"] == ""


def test_messages_equal_brute_force_on_a_tree():
    r = np.random.default_rng(1)
    nodes, ties = np.log(r.random((4, 3))), np.log(r.random((2, 3, 3)))
    ties = (ties + ties.transpose(0, 2, 1)) / 2
    edges = np.array([[0, 1, 0], [1, 2, 1], [1, 3, 0]]).T
    joint = np.zeros((3, 3, 3, 3))
    for at in np.ndindex(joint.shape):
        joint[at] = sum(nodes[i, at[i]] for i in range(4)) + sum(ties[k, at[a], at[b]] for a, b, k in edges.T)
    joint = np.exp(joint)
    got = pii.infer(nodes, edges, ties, rounds=60)
    for i in range(4):
        want = joint.sum(tuple(j for j in range(4) if j != i))
        assert np.allclose(got[i], want / want.sum(), atol=1e-2)


def test_redaction_joins_overlapping_spans():
    assert pii.redact("a 1.2.3.4@x.com b", [(2, 0, 15), (2, 1, 9)]) == "a [EMAIL] b"


def brute_align(a, b):
    best, table = 0, np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            same = a[i - 1] == b[j - 1] and b[j - 1] > 0
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if same else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
            best = max(best, table[i, j])
    return best


def test_alignment_equals_the_textbook():
    r = random.Random(2)
    pairs = [([r.randrange(1, 6) for _ in range(r.randrange(1, 12))], [r.randrange(6) for _ in range(r.randrange(1, 20))]) for _ in range(200)]
    got = decontaminate.align([np.array(a) for a, _ in pairs], [np.array(b) for _, b in pairs])
    assert got.tolist() == [brute_align(a, b) for a, b in pairs]


@pytest.mark.parametrize("block_bytes", [4 << 20, 200])
def test_leaks_of_copies_and_edited_copies(spark, block_bytes):
    items = [prose(900 + i, 24 + i) for i in range(8)]
    edited = items[3].split()
    for at in (4, 11, 18):
        edited[at] = "other"
    del edited[14]
    texts = [prose(i, 80) for i in range(30)]
    texts[2] += " " + items[0] + " " + prose(50, 20)
    texts[5] = items[1] + " " + texts[5] + " " + items[2].upper()
    texts[9] += " " + " ".join(edited)
    texts[11] += " " + " ".join(items[4].split()[:6])
    texts += [texts[2]] * 12
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(20, "too short"), (21, None), (22, "")], "item_id long, text string")
    rows = decontaminate.leaks(documents(spark, *texts), bench, block_bytes=block_bytes).collect()
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in rows}
    assert len(rows) == len(found)
    assert set(found) == {(2, 0), (5, 1), (5, 2), (9, 3), *[(30 + i, 0) for i in range(12)]}
    assert found[2, 0] == found[5, 1] == found[5, 2] == 1.0 and 0.6 < found[9, 3] < 1.0


@pytest.mark.parametrize("copies", [8, 50])
def test_edited_copies_are_found_however_many_there_are(spark, copies):
    """One whole copy and many equally edited ones: the n-grams left in the edited ones are the item's most common."""
    item = prose(950, 38)
    words = item.split()
    words[::6] = ["other"] * len(words[::6])
    phrase = " ".join(item.split()[:6])
    texts = [prose(1, 60) + " " + item] + [f"{prose(2 + i, 60)} {' '.join(words)} {prose(200 + i, 9)}" for i in range(copies)]
    texts += [f"{prose(400 + i, 60)} {phrase} {prose(600 + i, 40)}" for i in range(80)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = decontaminate.leaks(documents(spark, *texts), bench).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(copies + 1))
    assert all(0.6 < r["score"] < 0.9 for r in rows if r["doc_id"])


def test_leaks_equal_alignment_of_all_pairs(spark):
    """Every text against every item, whole against whole; items named by texts, over several blocks."""
    r = random.Random(8)
    items = {f"item {i}": prose(700 + i, r.randrange(8, 40)) for i in range(12)}
    texts = [prose(i, r.randrange(20, 120)) for i in range(30)]
    for i, item in enumerate(items.values()):
        words = item.split()
        for _ in range(i % 4):
            words[r.randrange(len(words))] = "edited"
        texts.append(prose(800 + i, 30) + " " + " ".join(words[: len(words) - i % 3]) + " " + prose(900 + i, 30))
    bench = spark.createDataFrame(list(items.items()), "item_id string, text string")
    rows = decontaminate.leaks(documents(spark, *texts), bench, block_bytes=400).collect()
    number = {}
    ids = lambda t: np.array([number.setdefault(w, len(number) + 1) for w in decontaminate.words_of(t)], "i4")
    want = {}
    for n, text in enumerate(texts):
        for name, item in items.items():
            share = decontaminate.align([ids(item)], [ids(text)])[0] / (decontaminate.MATCH * len(ids(item)))
            if share >= decontaminate.THRESHOLD:
                want[n, name] = share
    assert len(want) >= 12
    assert {(x["doc_id"], x["item_id"]): x["score"] for x in rows} == pytest.approx(want)


def test_texts_on_odd_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "ab ab ab ab ab"), (2, None)], "item_id long, text string")
    rows = decontaminate.query(spark, odd(spark), bench).collect()
    assert [(r["doc_id"], r["item_id"], r["score"]) for r in rows] == [(5, 1, 1.0)]
    assert decontaminate.query(spark, odd(spark).limit(0), bench).collect() == []
    assert decontaminate.query(spark, odd(spark), bench.limit(0)).collect() == []
    assert len(pii.query(spark, odd(spark)).collect()) == 9
    assert pii.query(spark, odd(spark).limit(0)).collect() == []


TURNS = [
    "Shall we meet?\nI am free on Monday.\n\nBring the report.",
    "On Mon A wrote:\n> Shall we meet?\n> I am free on  MONDAY.\n\nMonday is fine.",
    "B wrote:\n> On Mon A wrote:\n> > Shall we meet?\n>\n> Monday is fine.\n\nGreat, see you.",
    "> Bring the report.\nWhich one?", "A new topic", "> Which one?\nThe last.",
]


def test_quotes_link_to_who_said_them(spark):
    rows = [(1, i, "u", t, 0) for i, t in enumerate(TURNS)] + [(2, 0, "u", "Bring the report.", 0), (2, 1, "u", "> Monday is fine.\nno link", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, thread int")
    got = quotes.query(spark, df).orderBy("conv_id", "position").collect()
    assert [(r["turn"], r["reply_to"], r["thread"]) for r in got if r["conv_id"] == 1] == [
        (0, None, 0), (1, 0, 0), (2, 1, 0), (3, 0, 0), (5, 3, 0), (4, None, 4)]
    assert [r["text"] for r in got[:3]] == [TURNS[0], "Monday is fine.", "Great, see you."]
    assert [r["reply_to"] for r in got if r["conv_id"] == 2] == [None, None]
    assert not any(">" in r["text"] for r in got)


def test_rewrapped_paragraphs_of_a_longer_message_are_linked(spark):
    said = "One thing is that\nthe first part runs on.\n\nAnother thing is\nhow the second\npart goes.\n\nA third part."
    reply = "> One thing\n> is that the first part runs\n> on.\n>\n> Another thing is how\n> the second part goes.\n\nI agree."
    rows = [(1, 0, "a", said), (1, 1, "b", "Something else."), (1, 2, "c", reply)]
    found = quotes.query(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r["turn"]: r["reply_to"] for r in found} == {0: None, 1: None, 2: 0}


def test_one_long_conversation_keeps_its_order(spark):
    n = 700
    rows = [(1, i, "u", f"> line {i - 2}\nline {i}" if i >= 2 and i % 2 == 0 else f"line {i}") for i in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r["turn"]: r for r in quotes.query(spark, df).collect()}
    even, odd_turns = list(range(0, n, 2)), list(range(1, n, 2))
    assert [got[t]["position"] for t in even + odd_turns] == list(range(n))
    assert all(got[t]["thread"] == 0 for t in even)


def test_quotes_on_odd_and_empty_tables(spark):
    rows = [(None, 0, "u", None), (3, None, None, "x"), (3, 1, "u", "x"), (3, 1, "u", "x"), (3, 2, "u", "> x\n" * 3), (4, 0, "u", "> " * 5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = quotes.query(spark, df).orderBy("conv_id", "position").collect()
    assert [r["position"] for r in got] == [0, 0, 1, 2, 3, 0]
    assert got[4]["reply_to"] == 1 and got[4]["text"] == ""
    assert quotes.query(spark, df.limit(0)).collect() == []
