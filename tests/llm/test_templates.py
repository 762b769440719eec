from fleetspan.llm import templates

QUESTION = "A train travels 60 km in 2 hours. How far does Anna go in 5 hours if the speed of Anna is the same all day long?"
SCHEMA = "doc_id long, text string, item_id long, code string"


def test_exchanged_slots(spark):
    bench = spark.createDataFrame([(1, QUESTION), (2, "too short"), (3, None), (None, QUESTION), (4, QUESTION)], "item_id long, text string")
    other = QUESTION.replace("60", "80").replace("Anna", "Bob").replace("5 hours", "7 days").replace("2 hours", "3 days")
    loose = QUESTION.replace("the speed of Anna", "the speed of Carl")
    docs = [
        (1, "Intro words here. " + QUESTION + " And more."),
        (2, other),
        (3, loose),
        (4, None),
        (5, ""),
        (6, "word " * 100_000 + ". " + other.upper().replace("BOB", "Bob")),
        (7, "A train travels to the sea and nobody knows how far it goes in the long summer days of the year"),
        (None, QUESTION),
        (8, "Words. " + QUESTION[: len(QUESTION) // 3]),
        (9, QUESTION + " " + QUESTION),
        (9, QUESTION),
    ]
    frame = spark.createDataFrame([(*d, 5, "x") for d in docs], SCHEMA)
    out = {(r.doc_id, r.item_id): r for r in templates.leaks(frame, bench).collect()}
    assert set(out) == {(d, i) for d in (1, 2, 6, 9) for i in (1, 4)}
    assert out[1, 1].verbatim and not out[2, 1].verbatim
    assert out[2, 1].coverage == 1.0 and out[2, 1].n_slots >= 5


APPLES = "Anna has 5 apples and 3 pears. Bob gives Anna 4 more apples. Carl eats 2 of the pears. How many pieces of fruit does Anna have left?"


def test_names_that_begin_sentences_and_spelled_numbers(spark):
    names = APPLES.replace("Anna", "Mia").replace("Bob", "Tom").replace("Carl", "Paul")
    spelled = names.replace("5", "seven").replace("4", "6").replace("2", "three")
    loose = names.replace("gives Mia", "gives Ida")
    docs = [(1, names), (2, spelled), (3, APPLES), (4, APPLES.upper().replace("ANNA", "Anna")), (5, loose), (6, "Words here. " + names.replace("How many", "And how many"))]
    bench = spark.createDataFrame([(1, APPLES)], "item_id long, text string")
    out = {r.doc_id: r for r in templates.leaks(spark.createDataFrame([(*d, 5, "x") for d in docs], SCHEMA), bench).collect()}
    assert {1, 2, 3, 4} <= set(out) and 5 not in out
    assert out[1].coverage == out[2].coverage == out[3].coverage == 1.0
    assert out[3].verbatim and not out[1].verbatim and not out[2].verbatim


def test_edited_copies(spark):
    words = "the old mill by the river grinds corn for all farmers of the valley whenever the water is high enough to turn its wheel"
    put_in = words.replace("of the valley", "of the whole valley")
    left_out = words.replace("all farmers", "farmers")
    twice = put_in.replace("the old mill", "the mill").replace("water is high", "water there is high")
    full = APPLES.replace("Anna", "Mia van Dorn").replace("Bob", "Tom").replace("Carl", "Paul Miller")
    inside = QUESTION.replace("Anna", "Bob Smith")
    bench = spark.createDataFrame([(1, words), (2, APPLES), (3, QUESTION)], "item_id long, text string")
    docs = [(i, f"some words before it {d} and some after") for i, d in enumerate((words, put_in, left_out, "x. " + inside))]
    docs += [(10, f"Intro. {full}"), (11, words[: len(words) // 3]), (12, f"{words[:40]} {'other things ' * 30} {words[60:100]}"), (13, twice)]
    out = {(r.doc_id, r.item_id): r for r in templates.leaks(spark.createDataFrame([(*d, 5, "x") for d in docs], SCHEMA), bench).collect()}
    assert {(0, 1), (1, 1), (2, 1), (3, 3)} <= set(out) and not {11, 12} & {d for d, _ in out}
    assert out[0, 1].coverage == out[3, 3].coverage == 1.0 and 0.5 <= out[1, 1].coverage < 1
    assert not out[3, 3].verbatim


def test_against_plain_search(spark):
    import re

    folder = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    tokens = lambda t: " ".join(re.findall(r"[^\W_]+", (t or "").lower()))
    texts = [(r.doc_id, f" {tokens(r.text)} ") for r in docs.collect()]
    want = {(d, b.item_id) for b in bench.collect() for d, t in texts if f" {tokens(b.text)} " in t}
    assert want and {(r.doc_id, r.item_id) for r in templates.leaks(docs, bench).collect()} == want


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    docs = spark.createDataFrame([(1, QUESTION, 5, "x")], SCHEMA)
    assert templates.leaks(docs.limit(0), bench).count() == 0
    assert templates.leaks(docs, bench.limit(0)).count() == 0


def test_number_lists_short_items_and_values_that_fall_together(spark):
    listing = "Sort these: 3 9 4 7 12 5 8 1 6 2 11 10 15 14"
    rain = "Rainfall in the valley: 31 19 42 17 22 15 28 11 16 23 41 30 25 54 61"
    short, shorter = "What is seven times six", "Name it"
    bench = spark.createDataFrame([(1, listing), (2, short), (3, shorter), (4, QUESTION)], "item_id long, text string")
    merged = QUESTION.replace("60", "9").replace("2 hours", "9 hours").replace("5 hours", "9 hours")
    docs = [
        (1, rain), (2, f"Some text. {listing} and more"), (3, f"He asked: {short}? Nobody knew."), (4, "What is eight times six, they said"),
        (5, "Name it as you like"), (6, f"Well, {merged}"), (7, "what is seven"),
    ]
    out = {(r.doc_id, r.item_id): r for r in templates.leaks(spark.createDataFrame([(*d, 5, "x") for d in docs], SCHEMA), bench).collect()}
    assert set(out) - {(6, 4)} == {(2, 1), (3, 2)}
    assert out[3, 2].coverage == 1.0 and out[3, 2].verbatim
    assert (6, 4) not in out or out[6, 4].coverage < 1


def brute(docs, items):
    """Pairs whose item stands in the document with its numbers and names exchanged one to one, found by patterns."""
    import re

    found = set()
    for i, item in items:
        parts, names = [], {}
        for token in re.findall(r"\d+|[A-Za-z]+", item):
            if token.isdigit() or (token[0].isupper() and token not in ("How", "A")):
                if token in names:
                    parts.append(f"(?P={names[token]})")
                else:
                    names[token] = f"v{len(names)}"
                    parts.append(f"(?P<{names[token]}>" + (r"\d+)" if token.isdigit() else r"[A-Z][a-z]+)"))
            else:
                parts.append(token)
        pattern = re.compile(r"[^A-Za-z0-9]+".join(parts))
        for d, text in docs:
            for m in pattern.finditer(text):
                values = [m[n] for n in names.values()]
                if len(set(values)) == len(values):
                    found.add((d, i))
    return found


def test_exchanged_slots_against_patterns(spark):
    import random

    draw = random.Random(5)
    base = ["in the morning {a} baked {x} loaves of bread and sold {y} of them to {b} before noon so how many were left",
            "the garden of {a} has {x} rows of roses while that of {b} has {y} rows and nobody has counted them all yet"]
    fill = lambda t: t.format(a=draw.choice(["Mia", "Tom", "Ida"]), b=draw.choice(["Otto", "Jan", "Eva"]), x=draw.randint(10, 49), y=draw.randint(50, 99))
    items = [(i, fill(t)) for i, t in enumerate(base)]
    words = ["river", "stone", "cloud", "paper", "green", "quiet", "window", "letter"]
    other = lambda: " ".join(draw.choice(words) for _ in range(12))
    docs = [(d, f"{other()} and {fill(draw.choice(base)) if d % 2 else other()} then {other()}") for d in range(40)]
    frame = spark.createDataFrame([(*d, 5, "x") for d in docs], SCHEMA)
    got = templates.leaks(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute(docs, items) and len(brute(docs, items)) >= 15
