"""Families of documents: boilerplate that a copy group holds too, recurring lines longer than all others, content of copies."""

from tests.llm.conftest import prose
from ticksmith.llm import templates as tp


def test_a_copy_group_does_not_shield_boilerplate(spark, make_docs):
    licence = "Licensed to the public under the usual terms."
    rows = [(k, prose(500 + k, 60) + "\n" + licence, "s") for k in range(6)]
    base = prose(9, 120).split(" ")
    for k in range(60):
        words = list(base)
        words[k] = "edited"
        rows.append((100 + k, " ".join(words) + "\n" + licence, "s"))
    got = {r["doc_id"]: r["text"] for r in tp.document_lines(make_docs(rows)).collect()}
    assert all(got[i] == t.rsplit("\n", 1)[0] for i, t, _ in rows)


def test_the_content_of_a_copy_group_stays(spark, make_docs):
    base = prose(10, 200).split(" ")
    rows = []
    for k in range(40):
        words = list(base)
        words[60 + 2 * k] = "edited"
        rows.append((k, " ".join(words), "s"))
    got = {r["doc_id"]: r["text"] for r in tp.document_lines(make_docs(rows)).collect()}
    assert all(got[i] == t for i, t, _ in rows)


def test_a_recurring_line_may_be_the_longest(spark, make_docs):
    disclaimer = prose(11, 70, line=70)
    rows = [(k, prose(600 + k, 80, line=8) + "\n" + disclaimer, "s") for k in range(5)]
    got = {r["doc_id"]: r["text"] for r in tp.document_lines(make_docs(rows)).collect()}
    assert all(got[i] == t.rsplit("\n", 1)[0] for i, t, _ in rows)


def test_two_templates_share_a_leaf(spark, make_docs):
    """Token count and first tokens agree; both templates go, with their variable fields."""
    names = ["anna", "bert", "carla", "dora", "emil", "frida", "gustav", "hanna", "igor", "jana"]
    lines = [f"This page was written by {n} for our readers" for n in names] + [f"This page was last saved near {n} city hall" for n in names]
    rows = [(k, prose(700 + k, 80) + "\n" + line, "s") for k, line in enumerate(lines)]
    got = {r["doc_id"]: r["text"] for r in tp.document_lines(make_docs(rows)).collect()}
    assert all(got[i] == t.rsplit("\n", 1)[0] for i, t, _ in rows)


def test_edited_openings_of_copies_are_no_families(spark, make_docs):
    """A third of the copies have another opening of their longest line; their lines stay."""
    base = prose(12, 150).split("\n")
    rows = []
    for k in range(60):
        copy = list(base)
        longest = max(range(len(copy)), key=lambda j: len(copy[j]))
        copy[longest - 1] += f" {'abcdefghijklmnopqrst'[k % 20]}{'uvw'[k // 20]}"
        if k % 3 == 0:
            copy[longest] = f"{'abcdefghijklmnopqrst'[k // 3]}edit " + copy[longest]
        rows.append((k, "\n".join(copy), "s"))
    got = {r["doc_id"]: r["text"] for r in tp.document_lines(make_docs(rows)).collect()}
    assert all(got[i] == t for i, t, _ in rows)
