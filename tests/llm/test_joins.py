import itertools

import pytest

from placeforge.llm import decontaminate, ngram_join
from tests.llm.tables import documents, odd_texts, words


def brute_similar(texts, ids, n=5, threshold=0.8):
    """{row: (class rows, number of links)}"""
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    near = lambda a, b: a == b or len(a & b) >= threshold * len(a | b) > 0
    links = {i: set() for i in range(len(texts))}
    for i, j in itertools.combinations(range(len(texts)), 2):
        if near(sets[i], sets[j]):
            links[i].add(j)
            links[j].add(i)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (min(ids[k] for k in seen), len(links[i]))
    return out


def edited(text, at):
    w = text.split()
    for i in at:
        w[i] = "edited"
    return " ".join(w)


@pytest.mark.parametrize("block", [3, 512])
def test_similar_documents_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    base = words(5, 200)
    texts = [t for t in odd_texts() if t is None or len(t) < 60_000]
    texts += [edited(base, [i]) for i in range(0, 200, 12)] + [edited(base, [3, 60, 120, 180]), edited(base, range(0, 200, 5)), base, base]
    texts += [words(100 + i, 40) for i in range(20)]
    ids = list(range(1000, 1000 + len(texts)))
    found = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.similar_documents(documents(spark, texts, ids=ids).repartition(6)).collect()}
    expected = brute_similar(texts, ids)
    assert found == {ids[i]: v for i, v in expected.items()}
    assert max(n for _, n in found.values()) > 15


def test_similar_documents_with_null_ids_and_no_rows(spark):
    assert ngram_join.similar_documents(documents(spark, [])).count() == 0
    text = words(5, 50)
    found = ngram_join.similar_documents(documents(spark, [text, text, words(6, 50)], ids=[None, 4, None])).collect()
    assert sorted((r.n_copies, r.n_links, r.class_id) for r in found if r.n_copies > 1) == [(2, 1, 4), (2, 1, 4)]


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9995), (0.5, 0.9), (0.95, 0.999)):
        bands, rows = ngram_join.choose_bands(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall and bands * rows <= ngram_join.HASHES


QUESTION = "A farmer named Alice has 12 apples and gives Bob 5 apples, so how many apples does Alice have left after 3 days of walking 7 km?"


def items(spark, *texts):
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "item_id long, text string, doc_id int")


@pytest.mark.parametrize("small", [0, 10_000])
def test_decontamination_finds_items_and_their_variants(spark, monkeypatch, small):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", small)
    other = QUESTION.replace("Alice", "Maria").replace("Bob", "Henry").replace("12", "90").replace(" 5 ", " 17 ")
    mixed = other.replace("does Maria", "does Henry")  # one name of the item stands for two of the document
    plain = words(8, 40)
    texts = [
        words(1, 30) + ". " + QUESTION + " " + words(2, 30), words(3, 30) + ". " + other + " " + words(4, 10), words(6, 100), mixed, None, "",
        words(7, 20) + "\n" + plain.upper().replace(" ", "!! ") + "\n" + words(9, 20), " ".join(plain.split()[:7]),
        " ".join(plain.split()[10:24]), "three short words", "it has three short words inside", other, other,
    ]
    ids = [*range(len(texts) - 1), len(texts) - 2]
    bench = items(spark, QUESTION, plain, None, "", "three short words", "5 7 9")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(documents(spark, texts, ids=ids), bench).collect()}
    assert set(found) == {(0, 0), (1, 0), (6, 1), (8, 1), (9, 4), (10, 4), (11, 0)}
    assert found[0, 0].changed_slots == 0 and found[1, 0].changed_slots == 4 and found[0, 0].coverage > 0.9


def test_decontamination_of_empty_tables(spark):
    assert decontaminate.contaminated(documents(spark, []), items(spark, QUESTION)).count() == 0
    assert decontaminate.contaminated(documents(spark, odd_texts()), items(spark)).count() == 0


def test_decontamination_finds_literal_copies_of_names_and_slots(spark):
    slots = "On 5 May 1931 Ada Byron met Karl Weber 12 km from Bern Switzerland 40 years after 1891 while 300 men 20 tons"
    texts = [QUESTION.lower(), QUESTION.upper(), words(1, 9) + " " + slots + " " + words(2, 9), "so 5 7 9, then", "5 7 8", words(3, 40)]
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(documents(spark, texts), items(spark, QUESTION, slots, "5 7 9")).collect()}
    assert set(found) == {(0, 0), (1, 0), (2, 1), (3, 2)}
    assert all(r.coverage == 1 and r.changed_slots == 0 for r in found.values())


def test_decontamination_keeps_windows_beside_a_conflict(spark):
    """A filler on two places of which one was edited: only the windows over the edit are lost."""
    item = "the 12 " + words(11, 28) + " sold 12 " + words(12, 28)
    edited_copy = item.replace("sold 12", "sold 13")
    line = f"here Alice {words(21, 9)} Alice {words(22, 9)} Alice {words(23, 9)}"
    most = line.replace("Alice", "Maria", 2).replace("Alice", "Paula")  # two places of three decide
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(documents(spark, [edited_copy, most, item]), items(spark, item, line)).collect()}
    assert set(found) == {(0, 0), (1, 1), (2, 0)}
    assert found[0, 0].covered == 59 and found[0, 0].changed_slots == 0 and found[2, 0].coverage == 1
    assert found[1, 1].covered >= 20 and found[1, 1].changed_slots == 1


@pytest.mark.parametrize("broadcast", [300_000, 0])
def test_lines_of_many_items_are_no_find(spark, monkeypatch, broadcast):
    """A line that many items share says nothing of one of them; copies of the items are found, also of repeated ones."""
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", broadcast)
    line = "read the following text with care and then give the best answer to the question below it"
    texts = [f"{line} {words(100 + i, 12)}" for i in range(40)]
    items = [(i, t) for i, t in enumerate(texts)] + [(90, texts[0]), (91, texts[0]), (92, words(7, 30)), (None, words(8, 30))]
    docs = [words(2000 + i, 30) + f"\n{line}\n" + words(3000 + i, 30) for i in range(40)]  # clean
    docs += [words(600, 20) + " " + texts[5] + " " + words(601, 20), texts[0].upper(), " ".join(texts[7].split()[10:]), words(7, 30) + " x", words(8, 30)]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(documents(spark, docs), table).collect()}
    assert found == {(40, 5), (41, 0), (41, 90), (41, 91), (42, 7), (43, 92), (44, None)}


def test_template_families_are_found(spark):
    """Items that differ by their numbers and names only share their templates; another one of the family meets them all."""
    story = "a farmer named {} sold {} boxes of ripe fruit at the market and then bought {} more boxes from the old man next door"
    items = [(i, story.format(n, a, b)) for i, (n, a, b) in enumerate([("Anna", 12, 5), ("Boris", 31, 7), ("Clara", 44, 9)])]
    docs = [words(1, 20) + " . " + story.format("Dora", 77, 88) + " . " + words(2, 20), words(3, 60)]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(documents(spark, docs), table).collect()}
    assert found == {(0, 0), (0, 1), (0, 2)}
