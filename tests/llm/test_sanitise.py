"""Terms that disclose an entity from anywhere in its documents."""

from __future__ import annotations

from candlelake.llm import sanitise


def test_terms_far_from_a_rare_entity_are_marked_wherever_they_stand(make):
    filler = "the report of the week lists all figures by region " * 10
    rows = [(0, f"Quorbel {filler}quorbel first.last@corp.example {filler}end Quorbel")]
    rows += [(i, f"{filler}{filler}end number {i}") for i in range(1, 60)]
    docs = make(rows)
    found, text = {r.doc_id: r.spans for r in sanitise.span_report(docs).collect()}, rows[0][1]
    places = [i for i in range(len(text)) if text[i:i + 7].lower() == "quorbel"]
    email = text.index("first.last")
    assert found[0] == ",".join([f"email:{email}:{email + 23}", *(f"remove:{i}:{i + 7}" for i in places)])
    assert all(found[i] == "" for i in range(1, 60))
    clean = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    assert clean[0] == f" {filler} [EMAIL] {filler}end "
