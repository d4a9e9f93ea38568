"""Phone numbers in several spellings are one entity."""

from __future__ import annotations

import re

from fleetworks.llm import surrogates

KEY = b"a key"


def test_spellings_of_a_phone_share_a_surrogate(spark):
    spellings = ["+1 (614) 555-8001", "614-555-8001", "614.555.8001", "(614) 555-8001", "+16145558001"]
    abroad = ["+44 20 7946 0958", "+442079460958", "+44 614 555 8001"]
    texts = [f"call {s} now" for s in spellings + abroad]
    rows = surrogates.anonymize(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), KEY).orderBy("doc_id").collect()
    new = [re.sub("^call | now$", "", r["text"]) for r in rows]
    shape = lambda s: re.sub(r"\d", "9", s)
    assert [shape(n) for n in new] == [shape(s) for s in spellings + abroad]
    assert len({re.sub(r"\D", "", n)[-10:] for n in new[:5]}) == 1 and "6145558001" not in re.sub(r"\D", "", new[0])
    assert all(n.startswith("+1") for n in (new[0], new[4])) and all(n.startswith("+44") for n in new[5:])
    assert new[5].replace(" ", "") == new[6] != new[7].replace(" ", "")
    assert new[7][-12:].replace(" ", "") != new[1].replace("-", "")
