"""Texts with very long runs of blanks, which end the faster reader."""

from __future__ import annotations

import struct

import pytest

from fleetworks.llm import packing


@pytest.mark.parametrize("blank", [" ", "\t", "\n"])
def test_long_runs_of_blanks_are_encoded(blank):
    encoder = packing.encoder_for(packing.vocabulary())
    text = "padded" + blank * 1_500_000 + "text"
    ids = encoder.encode(text)
    assert encoder.tokenizer.decode(struct.unpack(f"<{len(ids) // 4}I", ids)) == text
