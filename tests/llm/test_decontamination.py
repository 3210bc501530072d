from slotwise.llm.decontamination import clean_documents, contaminated

from tests.llm.conftest import words

QUESTION = "A train leaves the old station at 7 hours and Alice rides 12 miles with Bob before she meets Alice again at 7 hours near the old mill."
OTHER = "A train leaves the old station at 9 hours and Carol rides 35.5 kg with Dan before she meets Carol again at 9 hours near the old mill."
MIXED = "A train leaves the old station at 9 hours and Carol rides 35 miles with Carol before she meets Dan again at 4 hours near the old mill."


def benchmark(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, hash string")


def found(docs, items):
    return sorted((r.doc_id, r.item_id) for r in contaminated(docs, items).collect())


def test_passages_with_other_slots(spark, make):
    plain = words(30, 1).replace("w", "q")
    items = benchmark(spark, [(1, QUESTION), (2, plain), (2, plain), (3, "too short here"), (4, None), (5, "one two three four five"),
                              (6, "green apples fall very far")])
    rows = [
        (10, QUESTION), (11, words(300, 2) + ". " + OTHER + " " + words(200, 3)), (12, MIXED), (13, words(400, 4)), (14, None), (15, ""),
        (16, "Begin " + plain.upper() + " end"), (17, "too short here"), (18, "They say green Apples fall very far."), (10, QUESTION),
        (19, words(200_000, 5) + " " + plain), (20, " ".join(plain.split()[:12])),
    ]
    docs = make(rows)
    # Document 12 repeats the words, but its names and numbers do not stand for one each.
    # In document 18 a capital makes a name of a word that the item has plainly.
    assert found(docs, items) == [(10, 1), (10, 1), (11, 1), (16, 2), (19, 2)]
    kept = clean_documents(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {12, 13, 14, 15, 17, 18, 20}


def test_windows_agree_with_brute_force(spark, make):
    items = [(i, words(20 + i, 50 + i, 300)) for i in range(6)]
    rows = [(i, words(60, 100 + i, 300)) for i in range(20)]
    rows += [(30 + i, words(9, i, 300) + " " + " ".join(t.split()[i : 12 + 2 * i]) + " " + words(9, i, 300)) for i, t in items]
    want = []
    for doc_id, text in rows:
        have = text.split()
        grams = {tuple(have[k : k + 8]) for k in range(len(have) - 7)}
        for item_id, item in items:
            parts = [tuple(item.split()[k : k + 8]) for k in range(len(item.split()) - 7)]
            if sum(p in grams for p in parts) >= 0.3 * len(parts):
                want.append((doc_id, item_id))
    assert want and found(make(rows), benchmark(spark, items)) == sorted(want)


def test_empty_tables(spark, make):
    docs = make([(1, QUESTION)])
    assert found(docs, benchmark(spark, [])) == []
    assert found(make([]), benchmark(spark, [(1, QUESTION)])) == []
    assert clean_documents(docs, benchmark(spark, [])).count() == 1


def test_one_edited_slot_drops_only_its_windows(spark, make):
    head, tail = words(30, 21).replace("w", "q"), words(30, 22).replace("w", "z")
    item = f"{head} 2 {tail} 2 more"
    start, end = words(10, 23, 90).replace("w", "a"), words(10, 24, 90).replace("w", "b")
    two = f"{start} 3 middle words come between here and there until now 5 {end}"
    items = benchmark(spark, [(1, item), (2, two)])
    rows = [(1, f"{head} 2 {tail} 7 more"), (2, f"{head} 7 {tail} 2 more"), (3, two.replace(" 3 ", " 4 ").replace(" 5 ", " 4 "))]
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_matched) for r in contaminated(make(rows), items).collect()}
    # Lost are the windows over the edited number only: 2 in document 1, 8 in document 2.
    assert set(got) == {(1, 1), (2, 1), (3, 2)}
    assert got[1, 1] == (56, 54) and got[2, 1] == (56, 48) and got[3, 2][0] == got[3, 2][1]
