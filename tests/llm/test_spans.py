"""Sentence runs against a plain version over the whole table."""

import random

from findry.llm import spans
from tests.llm.data import no_documents, odd_documents, prose, words


def plain_clean(rows):
    """Removes, per document in order of doc_id, the sentences of runs seen before."""
    seen, out = {}, {}
    for doc_id, text in sorted(rows):
        starts, norms, counts = spans.sentences(text)
        gone = set()
        for a, b in spans.runs(norms, counts):
            key = tuple(norms[a:b])
            if key in seen:
                gone.update(range(a, b))
            seen.setdefault(key, (doc_id, a))
        out[doc_id] = "".join(text[starts[i] if i else 0:starts[i + 1]] for i in range(len(norms))
                              if i not in gone)
    return out


def test_sentences_tile_the_text():
    rnd = random.Random(1)
    for text in ["", " ", "a", "A b. C d! E?\n\nF", " lead. trail \n", "x. y",
                 " ".join(words(rnd, 200)), " " + ", ".join(words(rnd, 90)), "  x y. z",
                 *(prose(rnd, n) for n in range(1, 20))]:
        starts, norms, counts = spans.sentences(text)
        assert sum(counts) == len(text.split()) == sum(len(n.split()) for n in norms)
        pieces = [text[a:b] for a, b in zip(starts, starts[1:])]
        assert [p.lower().split() for p in pieces] == [n.split() for n in norms]
        assert not norms or "".join(pieces) == text[starts[0]:]


def test_a_passage_is_cut_from_all_but_the_first(spark):
    rnd = random.Random(2)
    passage = prose(rnd, 9)
    rows = [(i, prose(rnd, 6) + " " + (passage + " " if i % 3 == 0 else "") + prose(rnd, 5))
            for i in range(30)]
    rows.append((50, rows[1][1] + "\n" + rows[1][1]))
    got = {r["doc_id"]: r for r in spans.clean(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = plain_clean(rows)
    inner = passage.split(". ", 1)[1].rsplit(". ", 1)[0]
    for doc_id, text in rows:
        r = got[doc_id]
        assert r["text"] == want[doc_id]
        assert text == "".join(
            [r["text"]] if not r["removed"] else
            [text]) and sum(e - s for s, e in r["removed"]) == len(text) - len(r["text"])
        assert (inner in r["text"]) == (doc_id == 0)
    assert got[50]["text"] == "" and got[1]["n_removed"] == 0
    clean = [i for i in range(30) if i % 3]
    assert all(got[i]["text"] == dict(rows)[i] for i in clean)


def test_a_passage_in_the_middle_of_lines_and_long_sentences(spark):
    rnd = random.Random(3)
    passage = " ".join(words(rnd, 70))
    rows = [(1, " ".join(words(rnd, 40)) + " " + passage + " " + " ".join(words(rnd, 40))),
            (2, " ".join(words(rnd, 55)) + " " + passage + " " + " ".join(words(rnd, 20)))]
    got = {r["doc_id"]: r["text"] for r in spans.clean(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1]
    left = set(got[2].split())
    assert sum(w in left for w in passage.split()) < 35
    assert all(w in left for w in rows[1][1].split()[:40])


def test_odd_rows(spark):
    docs = odd_documents(spark)
    cleaned = spans.clean(docs)
    assert [c for c in cleaned.columns if c not in ("n_removed", "removed")] == \
        [c for c in docs.columns if c != "removed"]
    rows = cleaned.collect()
    assert len(rows) == docs.count()
    assert sum(r["text"] is None for r in rows) == 2
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["n_removed"] == 0 and all(r["text"] == "" for r in by[2])
    assert by[3][0]["text"] == "" and by[5][0]["text"] == ""
    assert {r["text"] for r in by[7]} == {"one two", "another text here"}
    assert by[11][0]["text"] == ""
    assert spans.clean(no_documents(spark)).count() == 0


def test_any_passage_of_51_words_is_found_wherever_it_is_cut():
    rnd = random.Random(4)
    for _ in range(300):
        passage = prose(rnd, 12).split()
        at = rnd.randrange(len(passage) - 51)
        passage = " ".join(passage[at:at + 51])
        seen = []
        for _ in range(2):
            a, b = prose(rnd, 5).split(), prose(rnd, 5).split()
            a, b = a[:rnd.randint(1, len(a))], b[rnd.randint(0, len(b) - 1):]
            seen.append(" ".join(a) + " " + passage + " " + " ".join(b))
        first, second = (spans.shingles(t) for t in seen)
        common = {tuple(h) for h in first[1].tolist()}
        removals = [(-1 - a, h[0]) for a, h in zip(second[0].tolist(), second[1].tolist())
                    if tuple(h) in common]
        left, ranges, n = spans.cut(seen[1], removals)
        assert removals and n and sum(len(seen[1][a:b].split()) for a, b in ranges) >= 26
        assert all(seen[1][a:b].strip() in passage for a, b in ranges)


def test_a_text_of_one_word_repeated_keeps_its_first_shingle():
    places, _ = spans.shingles("so " * 200)
    assert places[0] == 0 and all(p >= spans.SHINGLE for p in places[1:])


def test_repeated_text_without_spaces_is_cut(spark):
    rnd = random.Random(5)
    def sentence(n):
        return "".join(chr(rnd.randrange(0x4E00, 0x9FA0)) for _ in range(n)) + "。"

    short = sentence(14) + sentence(15)
    passage = "".join(sentence(12) for _ in range(5))
    unended = "".join(sentence(60)[:-1] for _ in range(2))
    rows = [(1, short), (2, short), (3, sentence(20) + passage + sentence(20)),
            (4, sentence(30) + passage + sentence(9)), (5, sentence(8)[:-1] + unended + sentence(7)),
            (6, sentence(11)[:-1] + unended + sentence(12)), (7, sentence(9)), (8, "你好。")]
    rows += [(9, "你好。")]
    got = {r["doc_id"]: r["text"] for r in spans.clean(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    old = dict(rows)
    assert got[2] == "" and got[4] == old[4].replace(passage, "")
    assert all(got[i] == old[i] for i in (1, 3, 5, 7, 8, 9))
    assert len(old[6]) - len(got[6]) >= 120 - 2 * 25 and got[6][:11] == old[6][:11]
