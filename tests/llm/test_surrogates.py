"""Detection, formats, coreference and distinctness of surrogates."""

import random
import re

import pytest

from findry.llm import surrogates
from findry.llm.scratch import Scratch
from tests.llm.data import no_documents, odd_documents, prose

TEXT = """Mr. Karl Vogel wrote to Mrs. Rosa Maria Linde at Ka.V_92@Post3.test.example.org,
ka.v_92@post3.test.example.org. Call +1 (743) 555-3824, +1 743 555 3824 or 212-555-0187; pay by
5500 0000 0000 0004 or 4785380592391134$$$ from 152.143.123.131### 123-45-6789,
token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff". Karl Vogel knows Mr. Vogel.
Version 2.0 of 2026-12-01 10:20:30, 999.1.1.1, ISBN 978-3-16-148410-0. Госпожа, госпожа Анна Белова."""


def test_everything_is_found_and_nothing_else():
    kinds = [(kind, TEXT[a:b]) for a, b, kind, _ in surrogates.find(TEXT)]
    assert kinds == [
        ("given-m", "Karl"), ("family", "Vogel"), ("given-f", "Rosa"), ("given-f", "Maria"),
        ("family", "Linde"), ("email", "Ka.V_92@Post3.test.example.org"),
        ("email", "ka.v_92@post3.test.example.org"), ("phone", "+1 (743) 555-3824"),
        ("phone", "+1 743 555 3824"), ("phone", "212-555-0187"), ("card", "5500 0000 0000 0004"),
        ("card", "4785380592391134"), ("ip", "152.143.123.131"), ("ssn", "123-45-6789"),
        ("secret", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"), ("given-m", "Karl"),
        ("family", "Vogel"), ("family", "Vogel"), ("given-f", "Анна"), ("family", "Белова")]
    for text in ["", "2.0", "10:20:30", "a@b", "@", "x@", "3 + 4 = 7 (1 2 3)", "1.2.3", "Mr", "Mr. x",
                 "12345678", prose(random.Random(1), 200)]:
        assert surrogates.find(text) == []


def test_formats_types_and_coreference():
    new, spans = surrogates.replace(TEXT)
    by = {}
    for kind, a, b, value in spans:
        by.setdefault((kind, TEXT[a:b]), set()).add(value)
        assert value != TEXT[a:b]
        if kind in ("phone", "card", "ssn", "email"):
            shape = lambda s: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", s)))
            assert shape(value) == shape(TEXT[a:b])
    assert all(len(v) == 1 for v in by.values())
    one = {k: next(iter(v)) for k, v in by.items()}
    mails = [v for k, v in one.items() if k[0] == "email"]
    assert mails[0].lower() == mails[1] and mails[1].endswith(".org")
    phones = [re.sub(r"\D", "", v) for k, v in one.items() if k[0] == "phone"]
    assert phones[0] == phones[1] and phones[0][0] == "1"
    assert surrogates._luhn(one["card", "5500 0000 0000 0004"].replace(" ", "")) == 0
    assert surrogates._luhn(one["card", "4785380592391134"]) != 0
    assert all(1 <= int(x) <= 254 for x in one["ip", "152.143.123.131"].split("."))
    assert re.fullmatch("[а-я]+на", one["given-f", "Анна"].lower())
    assert one["given-m", "Karl"].endswith("n") and one["given-f", "Rosa"].endswith("a")
    for text in ("Karl", "Vogel", "example", "24be6443", "Белова", "555-3824"):
        assert text not in new
    assert "Version 2.0 of 2026-12-01 10:20:30, 999.1.1.1, ISBN 978-3-16-148410-0." in new
    assert surrogates.replace(TEXT, key=b"other")[0] != new


def test_distinct_entities_keep_distinct_surrogates(spark):
    values = [("given-f", f"name{i}") for i in range(4000)] + [("ip", "1.2.3.4"), ("ssn", "111223333")]
    # An entity that equals the first draw of another must not be given out.
    values.append(("given-f", surrogates.surrogate("given-f", "name7")))
    frame = spark.createDataFrame(values, "kind string, value string")
    again = {(r["kind"], r["value"]): r["draw"]
             for r in surrogates.redraws(frame, Scratch(spark, "test")).collect()}
    assert ("given-f", "name7") in again and len(again) > 100
    new = {(k, surrogates.surrogate(k, v, again.get((k, v), 0))) for k, v in values}
    assert len(new) == len(values)
    assert not new & set(values)


@pytest.mark.parametrize("bound", [100_000, 0])
def test_redrawn_entities_are_the_same_in_all_documents(spark, bound):
    rows = [(i, f"Mrs. Na{'abcdefghijklmnopqrstuvwxyz'[i % 26]}{'aeiou'[i // 26 % 5]}"
                f"{'klmnr'[i // 130 % 5]}a Berg met Mrs. Nabe Berg") for i in range(650)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in surrogates.pseudonymise(docs, exceptions=bound).collect()}
    names, seen = {}, {}
    for i, text in rows:
        for e in got[i]["entities"]:
            old = text[e["start"]:e["end"]]
            assert names.setdefault((e["kind"], old), e["surrogate"]) == e["surrogate"]
            assert seen.setdefault((e["kind"], e["surrogate"]), old) == old
    assert len(names) > 500 and "Berg" not in got[3]["text"]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    done = surrogates.pseudonymise(docs)
    assert done.columns == [*[c for c in docs.columns if c != "entities"], "entities"]
    before = sorted((r["doc_id"] or -1, r["text"] or "") for r in docs.collect())
    after = sorted((r["doc_id"] or -1, r["text"] or "") for r in done.collect())
    assert before == after  # nothing personal in them
    assert sum(r["text"] is None for r in done.collect()) == 2
    assert surrogates.pseudonymise(no_documents(spark)).count() == 0


def test_the_whole_of_a_long_local_part_is_replaced():
    a, b = ("abcdefghij" * 7 + c + "x" * 64 + "@example.org" for c in "pq")
    found = surrogates.find(f"to ..{a}, {b} c@d@example.com")
    assert [f[3] for f in found] == [a, b, "d@example.com"]
    assert surrogates.surrogate("email", a) != surrogates.surrogate("email", b)


def test_a_full_class_gives_longer_surrogates(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, f"write to {a}@{b}.de or +1 2{i % 10}") for i, (a, b) in enumerate(
        (a, b) for a in letters for b in letters)]
    rows.append((1000, "call +1 23 45"))
    got = surrogates.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    new = [e["surrogate"] for r in got for e in r["entities"] if e["kind"] == "email"]
    assert len(new) == len(set(new)) == 676
    assert not set(new) & {r[1].split()[2] for r in rows}
    assert all(len(n) >= 6 and n.endswith(".de") for n in new)


def test_later_mentions_of_a_titled_name_are_replaced():
    text = ("Dr. Anna Braun came with Mr. Karl Vogel. Vogel left, Karl stayed; Braun met Mrs. Anna Lund. "
            "Prof. Otto Lang and Miss Ida May spoke. Vogelsang is no Vogel.")
    new, spans = surrogates.replace(text)
    by = {}
    for kind, a, b, name in spans:
        by.setdefault((text[a:b]), set()).add((kind, name))
    assert all(len(v) == 1 for v in by.values())  # one name, one surrogate
    assert {"Anna", "Braun", "Karl", "Vogel", "Otto", "Lang", "Ida", "May", "Lund"} == set(by)
    assert next(iter(by["Anna"]))[0] == "given-f" and next(iter(by["Otto"]))[0] == "given-n"
    assert "Vogelsang" in new and not any(re.search(rf"\b{n}\b", new) for n in by)
