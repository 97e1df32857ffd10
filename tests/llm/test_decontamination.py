import re

from fixtures import CLASHING, frame
from reportloom.llm import decontamination as d
from reportloom.llm.common import table

QUESTION = "Then Mary has 40 apples and gives 2 lb of them to John who already owns 7 pears"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, docs, questions=((9, QUESTION),), clashing=False):
    got = d.contaminated(frame(spark, docs, clashing), items(spark, [*questions, (None, QUESTION), (3, None), (4, ""), (5, "too short")]))
    return {(r.doc_id, r.item_id): r.reparameterised for r in got.collect()}


def test_copies_and_new_parameters_are_caught_and_inconsistent_slots_are_not(spark):
    docs = [
        (1, f"so {QUESTION} ok"),
        (2, "Then Alice has 1,200 apples and gives 3.5 kg of them to Robert who already owns 9 pears"),
        (3, "Then Alice has 12 apples and gives 3 kg of them to Alice who already owns 9 pears"),  # one name for two
        (4, "Then we went home, and nothing of that kind was ever said again by anyone in this town."),
        (5, None),
        (6, ""),
        (None, f"{QUESTION}"),
        (1, f"so {QUESTION} ok"),
        (7, "filler words again " * 30_000 + QUESTION),
        (8, QUESTION.lower()),  # no names in it, but enough windows without any
    ]
    got = found(spark, docs, clashing=True)
    assert got == {(1, 9): False, (2, 9): True, (None, 9): False, (7, 9): False, (8, 9): False}
    kept = d.without_contaminated(frame(spark, docs, clashing=True), items(spark, [(9, QUESTION)]))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]


def test_slots_of_one_item_value_must_agree(spark):
    question = "Tom saw a boat on the river and Tom saw a boat on the lake"
    docs = [(1, "Ann saw a boat on the river and Ann saw a boat on the lake"), (2, "Ann saw a boat on the river and Bob saw a boat on the lake")]
    assert found(spark, docs, [(9, question)]) == {(1, 9): True}


def test_short_items_and_empty_tables(spark):
    short = "blue whales sing loudly"
    assert found(spark, [(1, f"we know {short} at night"), (2, "blue whales sing")], [(9, short)]) == {(1, 9): False}
    assert d.contaminated(frame(spark, [(1, "x")]).limit(0), items(spark, [(9, short)])).count() == 0
    assert d.contaminated(frame(spark, [(1, short)]), items(spark, []).limit(0)).count() == 0


def test_copies_of_items_made_of_slots_and_of_very_short_ones(spark):
    sums, cities = "What is 12 + 37 * 4 - 9 / 3 ?", "Paris Berlin Madrid Rome Vienna: which city hosted 1900?"
    questions = [(10, sums), (11, cities), (12, "Capital: Oslo"), (13, "kg of 3 4 plums")]
    docs = [
        (1, f"so {sums} ok"),
        (2, f"so {cities} ok"),
        (3, "it asked for the capital, Oslo"),
        (4, "we had 5 kg of 3 4 plums"),  # the first word is a unit here, but not in the item
        (5, "What is 13 + 37 * 4 - 9 / 3 ?"),
        (6, "Oslo is the capital"),
    ]
    assert found(spark, docs, questions) == {(1, 10): False, (2, 11): False, (3, 12): False, (4, 13): False, (5, 10): True}


def test_slot_heavy_items_names_of_several_words_and_words_put_in_between(spark):
    sums, weights = "What is 12 + 37 * 4 - 9 / 3 ?", "Compute 48 kg minus 13 kg plus 22 kg."
    trains = "A train leaves Boston at 9 and arrives in Chicago at 17, how long was it under way if it stood 2 hours"
    questions = [(10, sums), (11, weights), (12, trains)]
    words = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango uniform".split()
    questions.append((13, " ".join(words)))
    docs = [
        (1, "now: What is 5 + 6 * 71 - 80 / 2 ? Think"),
        (2, "Compute 4 kg minus 1 kg plus 3 kg."),
        (3, "So: " + trains.replace("Boston", "New York").replace("Chicago", "Los Angeles").replace("17", "21")),
        (4, " ".join([*words[:10], "and", "then", "came", "another", *words[10:]])),
        (5, " ".join([*words[10:], *words[:10]])),  # the halves in another order: each is a copy of half the item
        (6, "What is 5 + 6 of 71"),
        (7, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17"),
        (8, "Compute 4 kg minus 1 mile plus 3 days."),  # one unit would stand for three
        (9, "Compute 48 kg times 13 kg plus 22 kg."),
    ]
    got = found(spark, docs, questions)
    assert got == {(1, 10): True, (2, 11): True, (3, 12): True, (4, 13): False, (5, 13): False}


def plain_tokens(text):
    """Value, kind of each template token, by a loop over regular expressions."""
    out, end_of_name = [], None
    for m in re.finditer(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+", text):
        word, at = m.group(), m.start()
        if word[0].isdigit():
            out.append((word, "#"))
        elif out and out[-1][1] == "#" and word.lower() in d.UNITS.split():
            out.append((word.lower(), "unit"))
        elif len(word) > 1 and word[0].isupper() and word[1].islower() and word.lower() not in d.SENTENCE_STARTERS.split():
            if end_of_name is not None and text[end_of_name:at] == " ":
                out[-1] = (f"{out[-1][0]} {word.lower()}", "name")
            else:
                out.append((word.lower(), "name"))
            end_of_name = m.end()
            continue
        else:
            out.append((word.lower(), None))
        end_of_name = None
    return out


def plain_holds(text, item):
    """Whether the item's whole template stands anywhere in the text with consistent slots, by a loop over all positions."""
    own, theirs = plain_tokens(text), plain_tokens(item)
    for p in range(len(own) - len(theirs) + 1):
        part = own[p : p + len(theirs)]
        if any(a[1] != b[1] or a[1] is None and a[0] != b[0] for a, b in zip(part, theirs, strict=True)):
            continue
        pairs = {(a[1], b[0], a[0]) for a, b in zip(part, theirs, strict=True) if a[1]}
        names = [x for x in pairs if x[0] == "name"]
        if len({x[:2] for x in pairs}) == len(pairs) and len({x[2] for x in names}) == len(names):
            return True
    return False


def test_reparameterised_items_against_a_loop_over_all_positions(spark):
    import random

    rng = random.Random(4)
    names = ["Ann", "Bob", "New York", "Eve", "San Marino", "Ute", "Oslo"]
    vocabulary = "apples buys sells then goes walks pays shares finds counts with over under more fewer boxes each left right".split()

    def template():
        return [rng.choice(["#", "#", "N", "# kg", *vocabulary[rng.randrange(8) :]]) for _ in range(rng.randrange(5, 25))]

    def filled(parts):
        own = {}
        return " ".join(p if p in vocabulary else p.replace("#", str(rng.randrange(1, 9999))).replace("N", own.setdefault(p, rng.choice(names))) for p in parts)

    templates = [t for t in (template() for _ in range(40)) if sum(p in vocabulary for p in t) >= 3]
    questions = [(100 + i, filled(t)) for i, t in enumerate(templates)]
    filler = lambda: " ".join(rng.choices(["river", "house", "slowly", "7", "Mia", "green"], k=rng.randrange(3, 30)))
    docs = [(i, f"{filler()}. {filled(rng.choice(templates))}. {filler()}") for i in range(150)] + [(500 + i, filler()) for i in range(50)]
    want = {(i, item) for i, text in docs for item, question in questions if plain_holds(text, question)}
    got = set(found(spark, docs, questions))
    assert len(want) > 100 and len(want & got) >= 0.9 * len(want)
    assert not {i for i, _ in got} & set(range(500, 550))  # texts without any item
    whole = {i for i, _ in want}
    assert len({i for i, _ in got} - whole) <= 0.1 * len(docs)


def test_tokens_are_the_same_wherever_a_text_is_cut(spark, monkeypatch):
    from reportloom.llm import kernels

    docs = [(i, f"{i} {QUESTION}.") for i in range(40)]
    monkeypatch.setattr(kernels, "SLICE_BYTES", 10)
    assert len(found(spark, docs)) == 40


def test_generated_passages_are_found_and_clean_texts_are_left(spark):
    base = "/root/testdata/sf0.01"
    docs, benchmark = table(spark, base, "documents"), table(spark, base, "benchmark")
    got = {(r.doc_id, r.item_id) for r in d.contaminated(docs, benchmark).collect()}
    plain = lambda text: " ".join(re.findall(r"\w+", text.lower()))
    passages = {r.item_id: plain(r.text) for r in benchmark.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for own in [plain(r.text)] for i, p in passages.items() if p in own}
    assert got >= want and len(got - want) <= 0.05 * len(want)
