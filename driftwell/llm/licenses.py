"""Licence scans by sentence rules.

A text is normalised (lower case, runs of other characters than letters and digits become one blank, so
comment marks go too); ends of lines and of sentences stay marked as bounds. A known licence sentence is found
wherever its words run from one bound to another, whatever bounds lie between: a header may wrap its sentences over
lines, follow a copyright line without a full stop, or hold blank lines. Matches go left to right, the longest
first, without overlap. The identifiers found, in text order, are matched against ordered rules in the same way.

All of it is column expressions: no shuffle, no Python on the executors. A text that holds none of the
``HINTS`` can't hold a known sentence (each known sentence has one, which is checked when the module is
loaded), so only the others are searched.

Defined cases: a null or empty text has no sentence and no licence; repeated rows give repeated results; an empty
table gives an empty result; a very long text is one value of one row; of matches that begin at one place the longest
is taken; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, by identifier.
SENTENCES = {
    "apache_notice": "Licensed under the Apache License, Version 2.0.",
    "apache_notice_long": 'Licensed under the Apache License, Version 2.0 (the "License");'
    " you may not use this file except in compliance with the License.",
    "apache_copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache_as_is": "Unless required by applicable law or agreed to in writing, software distributed under the License"
    ' is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache_limits": "See the License for the specific language governing permissions and limitations under the License.",
    "mit_notice": "Released under the MIT License.",
    "mit_notice_other": "Licensed under the MIT License.",
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
    ' associated documentation files (the "Software"), to deal in the Software without restriction, including without'
    " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
    " Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit_keep": "The above copyright notice and this permission notice shall be included in all copies or substantial"
    " portions of the Software.",
    "mit_as_is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT'
    " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "bsd_grant": "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met:",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and"
    " the following disclaimer.",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and"
    " the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "gpl3_notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl_grant": "you can redistribute it and/or modify it under the terms of the GNU"
    " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
    " option) any later version.",
    "gpl_warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without"
    " even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl_details": "See the GNU General Public License for more details.",
    "cc_by_nc_notice": "Licensed under CC BY-NC 4.0.",
    "cc_by_notice": "Licensed under CC BY 4.0.",
    "cc_by_sa_notice": "Licensed under CC BY-SA 4.0.",
    "cc0_notice": "This work is licensed under CC0 1.0.",
    "all_rights": "All rights reserved.",
}
# Licences and the sentence sequences that state them.
RULES = {
    ("apache_notice_long", "apache_copy", "apache_as_is", "apache_limits"): "Apache-2.0",
    ("apache_notice_long",): "Apache-2.0",
    ("apache_notice",): "Apache-2.0",
    ("mit_grant", "mit_keep", "mit_as_is"): "MIT",
    ("mit_notice", "mit_grant", "mit_keep", "mit_as_is"): "MIT",
    ("mit_notice",): "MIT",
    ("mit_notice_other",): "MIT",
    ("bsd_grant", "bsd_source", "bsd_binary"): "BSD-2-Clause",
    ("gpl_grant", "gpl_warranty", "gpl_details"): "GPL-3.0-or-later",
    ("gpl_grant",): "GPL-3.0-or-later",
    ("gpl3_notice",): "GPL-3.0",
    ("cc_by_nc_notice", "all_rights"): "CC-BY-NC-4.0",
    ("cc_by_nc_notice",): "CC-BY-NC-4.0",
    ("cc_by_notice",): "CC-BY-4.0",
    ("cc_by_sa_notice",): "CC-BY-SA-4.0",
    ("cc0_notice",): "CC0-1.0",
    ("all_rights",): "All-Rights-Reserved",
}
HINTS = "(?i)licen|permi|redistrib|warrant|rights"
ENDS = r"([.!?:])[\x20\x09-\x0D]+"


def normalised(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


KNOWN = {normalised(s): k for k, s in SENTENCES.items()}
assert len(KNOWN) == len(SENTENCES) and all(re.search(HINTS, s) for s in SENTENCES.values())
BOUND = "\u0001"
_LONGEST_FIRST = sorted(KNOWN, key=lambda s: (-len(s), s))
_WORDS = "|".join(s.replace(" ", f"[ {BOUND}]+") for s in _LONGEST_FIRST)
SENTENCE = f"(?:^|{BOUND}) ?({_WORDS})(?= ?(?:{BOUND}|$))"
ORDERED = sorted(RULES, key=lambda rule: (-len(rule), rule))
PATTERN = "|".join("".join(f"<{k}>" for k in rule) for rule in ORDERED)
LICENCE_OF = {"".join(f"<{k}>" for k in rule): name for rule, name in RULES.items()}


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def identifiers(text: Column) -> Column:
    """Known sentences of a text, in order, as ``<id><id>...``."""
    bounds = F.regexp_replace(F.regexp_replace(text, ENDS, f"$1{BOUND}"), "\n", BOUND)
    plain = F.regexp_replace(F.lower(bounds), f"[^a-z0-9{BOUND}]+", " ")
    known = _map(KNOWN)
    found = F.transform(
        F.regexp_extract_all(plain, F.lit(SENTENCE), 1),
        lambda run: F.concat(F.lit("<"), F.element_at(known, F.regexp_replace(run, f"[ {BOUND}]+", " ")), F.lit(">")),
    )
    return F.when(text.rlike(HINTS), F.array_join(found, "")).otherwise(F.lit(""))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_sentences, sentence_ids, licenses, n_licenses``: what every text states, repeats included."""
    found = docs.select("doc_id", identifiers(F.coalesce(F.col("text"), F.lit(""))).alias("sentence_ids"))
    names = _map(LICENCE_OF)
    runs = F.transform(F.regexp_extract_all("sentence_ids", F.lit(f"({PATTERN})")), lambda run: F.element_at(names, run))
    return found.select(
        "doc_id",
        F.regexp_count("sentence_ids", F.lit("<")).cast("long").alias("n_sentences"),
        "sentence_ids",
        F.array_join(runs, ",").alias("licenses"),
        F.size(runs).cast("long").alias("n_licenses"),
    )
