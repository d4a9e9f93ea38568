"""Licence expressions with identifiers beyond the table."""

from __future__ import annotations

import pytest

from fleetworks.llm import licenses


@pytest.mark.parametrize("line, shown, permissive, labels", [
    ("MIT AND SSPL-1.0", "(mit and sspl-1.0)", None, "mit,sspl-1.0"),
    ("BUSL-1.1", "busl-1.1", None, "busl-1.1"),
    ("GPL-1.0-or-later", "gpl-1.0-or-later", None, "gpl-1.0-or-later"),
    ("(MIT OR Artistic-2.0)", "(mit or artistic-2.0)", True, "artistic-2.0,mit"),
    ("NCSA */", "ncsa", None, "ncsa"),
    ("curl", "curl", None, "curl"),
    ("GPL-2.0-only WITH Font-exception-2.0 -->", "(gpl-2.0-only with font-exception-2.0)", False, "gpl-2"),
    ("EPL-1.0+ or mit", "(epl-1.0+ or mit)", True, "epl-1.0,mit"),
    ("GPL-3.0+", "gpl-3.0+", False, "gpl-3"),
    ("GPL-3.0-only AND PostgreSQL", "(gpl-3.0-only and postgresql)", False, "gpl-3,postgresql"),
    ("GPL-3.0-only OR BSL-1.0", "(gpl-3.0-only or bsl-1.0)", None, "bsl-1.0,gpl-3"),
    ("MIT/Apache-2.0", "(mit or apache-2.0)", True, "apache-2,mit"),
    ("MIT or Apache", None, None, ""),
    ("MIT and (Apache", None, None, ""),
    ("MIT // Copyright", "mit", True, "mit"),
    ("MIT or later text", "mit", True, "mit"),
    ("MIT with no changes", "mit", True, "mit"),
    ("See LICENSE for details", None, None, ""),
    ("MIT AND", None, None, ""),
    ("MIT AND the rest", None, None, ""),
    ("NOASSERTION", None, None, ""),
    ("12 files", None, None, ""),
])
def test_any_identifier_is_read_whole(line, shown, permissive, labels):
    found = licenses.Scanner(licenses.BASE_PHRASES, {}).scan(f"// SPDX-License-Identifier: {line}\nnext line")
    assert found[-2:] == ([shown] if shown else [], permissive) and found[5] == labels
