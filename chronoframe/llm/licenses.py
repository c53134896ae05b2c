"""Licence scans by sentence rules.

A text is cut into sentences, at marks before white space and at blank lines;
a sentence is normalised (A-Z lowered, all but a-z and 0-9 made one space) and
looked up among the known licence sentences, and so is every run of whole lines
of it: a heading or copyright line hides no wrapped sentence below it. Of known
sentences that start alike, the longest is taken. The identifiers found, in
text order, form the document's identifier sequence; unknown sentences between
them are passed over up to ``MAX_GAP`` of them. A licence rule is an ordered
list of identifiers and matches where the sequence holds it without another
identifier between. Known sentences may hold such marks themselves; they are
found as a whole, whether or not the text is cut there.

Cases: null and empty texts have no sentence and no licence; rows equal in id
and text are one document and all get its result; a null id is kept; repeated
sentences match as often as they stand; no rows give no rows; other columns
are not read.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoframe.llm.common import LOWER, UPPER, ship

#: Unknown sentences allowed between two sentences of one rule.
MAX_GAP = 1

#: Known licence sentences by identifier.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "mit-grant": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "mit-condition": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software."
    ),
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-2.0-compliance": "You may not use this file except in compliance with the License.",
    "apache-2.0-copy": "You may obtain a copy of the License at",
    "gpl-grant": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "gpl-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
}
#: Licence rules, each an ordered list of identifiers.
RULES = {
    "Apache-2.0": [["apache-2.0-notice"], ["apache-2.0-header", "apache-2.0-compliance"], ["apache-2.0-compliance", "apache-2.0-copy"]],
    "BSD": [["bsd-grant", "bsd-source"]],
    "CC-BY-NC-4.0": [["cc-by-nc-4.0-notice"]],
    "GPL-3.0": [["gpl-3.0-notice"], ["gpl-grant", "gpl-warranty"], ["gpl-grant"]],
    "ISC": [["isc-grant"]],
    "MIT": [["mit-notice"], ["mit-grant", "mit-condition"]],
}
#: Further known sentences and rules. The SQL knows the tables
#: above alone.
MORE_SENTENCES = {
    "gpl-2.0-grant": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version."
    ),
    "gpl-2.0-only-grant": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License version 2 as published by the Free Software Foundation."
    ),
    "lgpl-2.1-grant": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version."
    ),
    "lgpl-3.0-grant": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."
    ),
    "lgpl-3.0-library-grant": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."
    ),
    "agpl-3.0-grant": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."
    ),
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "epl-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at"
    ),
    "unlicense-grant": "This is free and unencumbered software released into the public domain.",
    "bsl-1.0-header": "Distributed under the Boost Software License, Version 1.0.",
    "isc-grant-and": (
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "zlib-grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions:"
    ),
    "bsd-style-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
}
MORE_RULES = {
    "AGPL-3.0": [["agpl-3.0-grant"]],
    "BSD": [["bsd-style-notice"]],
    "BSL-1.0": [["bsl-1.0-header"]],
    "EPL-2.0": [["epl-2.0-header"]],
    "GPL-2.0": [["gpl-2.0-grant"], ["gpl-2.0-only-grant"]],
    "ISC": [["isc-grant-and"]],
    "LGPL-2.1": [["lgpl-2.1-grant"]],
    "LGPL-3.0": [["lgpl-3.0-grant"], ["lgpl-3.0-library-grant"]],
    "MPL-2.0": [["mpl-2.0-header"]],
    "Unlicense": [["unlicense-grant"]],
    "Zlib": [["zlib-grant"]],
}


def _gnu(kind: str, version: str) -> list[str]:
    letters = "".join(w[0] for w in f"{kind} General Public License".split())
    return [
        f"GNU {kind} General Public License{mid} {version}".replace("  ", " ") for mid in (", version", " version", " v.", "")
    ] + [f"GNU {kind} General Public License v{version}".replace("  ", " ")] + [
        f"{g}{letters}{form}{version}" for g in ("", "GNU ") for form in ("v", " v", "-", " ", " version ")
    ]


def _cc(code: str, words: str, version: str) -> list[str]:
    return [f"{cc} {code} {version}" for cc in ("CC", "Creative Commons")] + [
        f"Creative Commons {words} {version}{scope}" for scope in ("", " International", " Unported")
    ]


#: Names of a licence as a notice has them, after "Released under
#: the" and the like, "License" behind them or not.
NAMES = {
    "AGPL-3.0": [n for v in ("3.0", "3") for n in _gnu("Affero", v)],
    "Apache-2.0": [
        "Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache License, Version 2", "Apache 2.0", "Apache 2",
        "Apache v2", "Apache Version 2.0", "Apache License v2", "Apache Software License, Version 2.0", "Apache Software License 2.0",
    ],
    "BSD": [f"{n}{w}" for n in ("", "New ", "Modified ", "Simplified ", "2-Clause ", "3-Clause ") for w in ("BSD", "BSD-style")]
    + ["BSD 2-Clause", "BSD 3-Clause", "BSD 2-Clause Simplified", "BSD 3-Clause New", "two-clause BSD", "three-clause BSD"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0", "Boost Software"],
    "CC0-1.0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero", "Creative Commons Zero v1.0 Universal", "Creative Commons CC0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, Version 2.0", "EPL-2.0", "EPL v2.0"],
    "GPL-2.0": [n for v in ("2.0", "2") for n in _gnu("", v)],
    "GPL-3.0": [n for v in ("3.0", "3") for n in _gnu("", v)],
    "ISC": ["ISC"],
    "LGPL-2.1": _gnu("Lesser", "2.1"),
    "LGPL-3.0": [n for v in ("3.0", "3") for n in _gnu("Lesser", v)],
    "MIT": ["MIT", "MIT/X11", "Expat", "MIT (Expat)"],
    "MPL-2.0": [
        "Mozilla Public License 2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License v2.0",
        "Mozilla Public License, v. 2.0", "MPL 2.0", "MPL v2.0", "MPLv2",
    ],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib"],
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause"],
} | {
    f"CC-{code}-{version}": _cc(code, words, version)
    for version in ("4.0", "3.0", "2.5", "2.0")
    for code, words in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    )
}
#: Identifiers of SPDX lines, beside the keys of ``NAMES``.
SPDX = {
    "BSD": ["BSD-2-Clause", "BSD-3-Clause"],
    "GPL-2.0": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-2.0+"], "GPL-3.0": ["GPL-3.0-only", "GPL-3.0-or-later", "GPL-3.0+"],
    "LGPL-2.1": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-2.1+"], "LGPL-3.0": ["LGPL-3.0-only", "LGPL-3.0-or-later", "LGPL-3.0+"],
    "AGPL-3.0": ["AGPL-3.0-only", "AGPL-3.0-or-later", "AGPL-3.0+"],
}
#: How a notice starts (normalised), and an SPDX line.
_SUBJECT = (
    "(?:(?:this|the|our|all) (?:(?:source )?code|work|project|software|program|library|package|file|document|text|content|contents|article|"
    "page|site|data|dataset|repository|material|module|book|image|tool) (?:is|are) |it is )?(?:free software )?"
)
_UNDER = (
    "(?:dual )?(?:licensed|licenced|released|distributed|published|provided|available|made available|shared|covered|offered|open sourced) "
    "under (?:the )?(?:terms of )?(?:(?:the|a|an) )?"
)
_NOTICE, _SPDX = _SUBJECT + _UNDER, "spdx license identifier "
_END, _BREAK, _KEPT = r"([.!?:;])[ \t\r]+", r"[ \t\r]*\n[ \t\r\n]*", "[^a-z0-9]+"


#: A mark before white space ends a sentence.
_MARK = r"[.!?:;][ \t\r\n]+"
#: Every known sentence holds a word with one of these; texts without them are
#: not looked into.
STEMS = ("licen", "permission", "redistribut", "warrant", "unencumbered", "under")


def normalise(sentence: str) -> str:
    return re.sub(_KEPT, " ", sentence.translate(str.maketrans(UPPER, LOWER))).strip()


def _pattern(sentence: str) -> str:
    """The sentence in a text of :func:`marked`, wrapped anywhere. Its own marks
    (``free software: you``) may have cut it there as they cut a text."""
    parts = (normalise(x).replace(" ", "[ \n]") for x in re.split(_MARK, sentence))
    return r"[ |\n]".join(filter(None, parts))


def _names() -> dict[str, str]:
    """Normalised name in a notice → licence."""
    found = {}
    for licence, names in NAMES.items():
        for n in (licence, *names):
            n = re.sub(" licen[cs]e$", "", normalise(n))
            found |= {n + end: licence for end in ("", " license", " licence", " or later", " or any later version", " license or later")}
    return found


def _spdx() -> dict[str, str]:
    return {normalise(n): licence for licence in NAMES for n in (licence, *SPDX.get(licence, []))}


def identifiers() -> tuple[dict[str, str], dict[str, list[list[str]]]]:
    """Identifier of every sentence in ``<>``, by the sentence or, for notices
    and SPDX lines, by the name in it; and all rules."""
    known = {f"notice {n}": f"{x.lower()}-notice" for n, x in _names().items()} | {f"spdx {n}": f"{x.lower()}-spdx" for n, x in _spdx().items()}
    known |= {normalise(s): i for i, s in (MORE_SENTENCES | SENTENCES).items()}
    rules = {x: [*RULES.get(x, []), *MORE_RULES.get(x, [])] for x in {**RULES, **MORE_RULES, **NAMES}}
    for x in NAMES:
        rules[x] += [[i] for i in (f"{x.lower()}-notice", f"{x.lower()}-spdx") if [i] not in rules[x]]
    return known, rules


def marked(lowered: Column) -> Column:
    """The normalised text with ``|`` between sentences and a line feed between
    lines of one, and either at both ends; known sentences stand in ``<>``."""
    text = F.concat(F.lit("|"), F.translate(lowered, "|", ","), F.lit("|"))
    # a line in other letters is an unknown sentence, one without any is blank
    other = r"(?<=[|\n])[^a-z0-9|\n\p{L}]*+\p{L}[^a-z0-9|\n]*+(?=[|\n])"
    for found, put in (
        (_MARK, "|"), (other, "x"), (r"[^a-z0-9|\n]+", " "), (r"\n[ \n]*\n", "|"), (r"[ \n]*\|[ |\n]*", "|"),
        (r" ?\n ?", "\n"),
    ):
        text = F.regexp_replace(text, found, put)
    def wrapped(names) -> str:
        # the mark of "v. 2.0" may have cut the text
        patterns = (re.sub(" v (?=[0-9])", " v@", n).replace(" ", "[ \n]").replace("@", r"[ |\n]") for n in names)
        return "|".join(sorted(patterns, key=len, reverse=True))

    known = "|".join(_pattern(s) for s in sorted((SENTENCES | MORE_SENTENCES).values(), key=len, reverse=True))
    known += "|" + _NOTICE.replace(" ", "[ \n]") + "(?:" + wrapped(_names()) + ")"
    known += "|" + _SPDX[:-1].replace(" ", "[ \n]") + r"[ |\n](?:" + wrapped(_spdx()) + ")"
    return F.regexp_replace(text, rf"[|\n]({known})(?=[|\n])", "|<$1>")


def recognise(docs: DataFrame) -> DataFrame:
    """``doc_id, ids``: identifiers with the number of unknown sentences before
    each, in order."""
    ship(docs.sparkSession)
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lowered.alias("lowered"))
    hints = [F.contains("lowered", F.lit(s)) for s in STEMS]
    any_hint = hints[0]
    for hint in hints[1:]:
        any_hint = any_hint | hint
    # unknown and known parts take turns, unknown ones first and last
    rows = rows.select("doc_id", F.when(any_hint, F.split(marked(F.col("lowered")), "[<>]")).otherwise(F.array(F.lit(""))).alias("parts"))
    names = F.from_json(F.lit(json.dumps(identifiers()[0])), "map<string,string>")

    def found(part: Column, at: Column) -> Column:
        said = F.translate(part, "|\n", "  ")
        name = F.regexp_replace(F.regexp_replace(said, f"^{_SPDX}", "spdx "), f"^{_NOTICE}", "notice ")
        before = F.split(F.get("parts", at - 1), r"\|")
        return F.struct(
            F.when(at % 2 == 1, F.coalesce(names[said], names[name])).alias("id"),
            F.size(F.filter(before, lambda x: F.trim(F.translate(x, "\n", " ")) != "")).alias("gap"), (at % 2).alias("known"),
        )

    return rows.select("doc_id", F.filter(F.transform("parts", found), lambda x: x["known"] == 1).alias("ids"))


def _matches(ids: Column, rule: list[str]) -> Column:
    """Whether the identifier sequence holds the rule."""
    def here(x: Column, i: Column) -> Column:
        ok = x["id"] == rule[0]
        for k, name in enumerate(rule[1:], 1):
            later = F.get(ids, i + k)
            ok = ok & F.coalesce((later["id"] == name) & (later["gap"] <= MAX_GAP), F.lit(False))
        return ok

    return F.exists(F.transform(ids, here), lambda x: x)


def scan(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_known`` (licence sentences found),
    ``identifiers`` and ``licences`` (comma-joined, the latter sorted)."""
    ids = F.col("ids")
    named = []
    for name, rules in sorted(identifiers()[1].items()):
        alone, ordered = [r[0] for r in rules if len(r) == 1], [r for r in rules if len(r) > 1]
        any_rule = F.arrays_overlap(F.transform(ids, lambda x: x["id"]), F.array(*map(F.lit, alone))) if alone else F.lit(False)
        for rule in ordered:
            any_rule = any_rule | _matches(ids, rule)
        named.append(F.when(any_rule, F.lit(name)))
    return recognise(docs).select(
        "doc_id", F.size(ids).cast("long").alias("n_known"), F.array_join(F.transform(ids, lambda x: x["id"]), ",").alias("identifiers"),
        F.when(F.size(ids) > 0, F.array_join(F.array(*named), ",")).otherwise("").alias("licences"),
    )


def oracle_sql() -> str:
    """The scan of sentences on one line in DuckDB, straight from the rules."""
    known = ", ".join("('{}', '{}')".format(i, s.replace("'", "''")) for i, s in SENTENCES.items())
    lower = f"translate({{}}, '{UPPER}', '{LOWER}')"
    norm = "trim(regexp_replace(" + lower + f", '{_KEPT}', ' ', 'g'))"

    def matches(rule: list[str]) -> str:
        steps = [f"ids[i] = '{rule[0]}'"] + [
            f"ids[i + {k}] = '{name}' AND ats[i + {k}] - ats[i + {k - 1}] <= {MAX_GAP + 1}" for k, name in enumerate(rule[1:], 1)
        ]
        return f"len(list_filter(range(1, len(ids) + 1), lambda i: coalesce({' AND '.join(steps)}, false))) > 0"

    cases = ", ".join(
        f"CASE WHEN {' OR '.join(matches(r) for r in rules)} THEN '{name}' END" for name, rules in sorted(RULES.items())
    )
    return f"""
WITH known AS (SELECT id, {norm.format('raw')} AS sentence FROM (VALUES {known}) AS v(id, raw)),
cut AS (SELECT doc_id, string_split_regex(regexp_replace(coalesce(text, ''), '{_END}', '\\1' || chr(10), 'g'), '{_BREAK}') AS parts FROM documents),
rows AS (SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) AS nr FROM cut),
hit AS (SELECT r.doc_id, r.nr, k.id FROM rows r JOIN known k ON {norm.format('r.raw')} = k.sentence),
seq AS (SELECT doc_id, list(id ORDER BY nr) AS ids, list(nr ORDER BY nr) AS ats FROM hit GROUP BY doc_id),
ruled AS (SELECT doc_id, len(ids) AS n, array_to_string(ids, ',') AS names,
  array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), ',') AS licences FROM seq)
SELECT d.doc_id, coalesce(r.n, 0)::BIGINT AS n_known, coalesce(r.names, '') AS identifiers, coalesce(r.licences, '') AS licences
FROM documents d LEFT JOIN ruled r ON d.doc_id = r.doc_id
"""
