"""Licence scans by sentence rules: sentences become identifiers, sequences of identifiers become licences.

A text is cut into sentences, each is normalised and looked up among known licence sentences; the identifiers of a text,
in order, are matched against an ordered list of rules. Only built-in expressions are used, and no row leaves its task.
"""

from pyspark.sql import functions as F

# Words of which every known sentence has at least one.
KEYWORDS = ("licen[cs]e", "copyright", "permission", "redistribut", "warrant", "liab", "public domain", "altered source", "misrepresented", "all rights reserved", "neither the name", "gnu", "version [23]", "cc0", "creative commons")

# How a line begins that starts a sentence even if the line before it has no full stop.
OPENERS = ("Copyright", "Licensed", "Released", "Distributed", "Published", "This ", "The above", "THE SOFTWARE", "THIS SOFTWARE", "Permission", "Redistribution", "Neither", "SPDX-License-Identifier", "You may", "Unless required", "See the", "All rights")

# Identifier and pattern of a whole normalised sentence.
SENTENCES = (
    ("SPDX", r"(.* )?spdx-license-identifier [a-z0-9.+()-]+( .*)?"),
    ("Copyright", r"(portions )?copyright .*"),
    ("AllRights", r".*all rights reserved"),
    ("ApacheRef2.0", r".*licen[cs]ed under (the )?apache licen[cs]e,? version 2\.0.*"),
    ("ApacheObtain", r"you may obtain a copy of the licen[cs]e at.*"),
    ("ApacheNot", r"you may not use this file except in compliance with the licen[cs]e"),
    ("ApacheAsIs", r"unless required by applicable law or agreed to in writing, software distributed under the licen[cs]e is distributed on an as is basis.*"),
    ("ApacheSee", r"see the licen[cs]e for the specific language governing permissions and limitations under the licen[cs]e"),
    ("MITref", r".*(released|licen[cs]ed|distributed) under (the )?(terms of the )?mit licen[cs]e"),
    ("MITperm", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software.*"),
    ("MITnotice", r"the above copyright notice and this permission notice shall be included in all copies.*"),
    ("AsIs", r"the software is provided as is,? without warranty of any kind.*"),
    ("NoLiability", r"in no event shall the (authors|copyright).* be liable.*"),
    ("ISCperm", r"permission to use, copy, modify, and(/or)? distribute this software for any purpose with or without fee is hereby granted.*"),
    ("BSDref", r".*(released|licen[cs]ed|distributed) under (the )?(terms of the )?(new |simplified |revised |2-clause |3-clause )?bsd( 2-clause| 3-clause)? licen[cs]e"),
    ("BSDpre", r"redistribution and use in source and binary forms, with or without modification, are permitted.*"),
    ("BSDsource", r".*redistributions of source code must retain the above copyright notice.*"),
    ("BSDbinary", r".*redistributions in binary form must reproduce the above copyright notice.*"),
    ("BSDname", r".*neither the name of .* may be used to endorse or promote products.*"),
    ("BSDasIs", r"this software is provided by the .* as is and any express or implied warranties.*"),
    ("AGPLref3", r".*gnu affero general public licen[cs]e.*version 3.*"),
    ("LGPLref2.1", r".*gnu lesser general public licen[cs]e.*version 2\.1.*"),
    ("LGPLref3", r".*gnu lesser general public licen[cs]e.*version 3.*"),
    ("GPLref2", r".*gnu general public licen[cs]e.*version 2.*"),
    ("GPLref3", r".*gnu general public licen[cs]e.*version 3.*"),
    ("AGPLpub", r".*gnu affero general public licen[cs]e.* published by .*"),
    ("LGPLpub", r".*gnu lesser general public licen[cs]e.* published by .*"),
    ("GPLpub", r".*gnu general public licen[cs]e.* published by .*"),
    ("Version2.1", r"(either )?version 2\.1([ ,].*)?"),
    ("Version2", r"(either )?version 2(\.0)?([ ,].*)?"),
    ("Version3", r"(either )?version 3(\.0)?([ ,].*)?"),
    ("GPLnoWarranty", r"this program is distributed in the hope that it will be useful,? but without any warranty.*"),
    ("GPLcopy", r"you should have received a copy of the gnu .*licen[cs]e.*"),
    ("MPLref2.0", r".*mozilla public licen[cs]e,? (v\.? ?|version )2\.0.*"),
    ("EPLref2.0", r".*eclipse public licen[cs]e.*2\.0.*"),
    ("BoostRef", r".*boost software licen[cs]e.*version 1\.0.*"),
    ("ZlibAsIs", r"this software is provided as-is,? without any express or implied warranty"),
    ("ZlibOrigin", r".*the origin of this software must not be misrepresented.*"),
    ("ZlibAltered", r".*altered source versions must be plainly marked as such.*"),
    ("CC0ref", r".*(cc0 1\.0|creative commons zero).*"),
    ("CCBYNCSAref4.0", r".*licen[cs]ed under (a )?(cc by-nc-sa 4\.0|creative commons attribution-noncommercial-sharealike 4\.0).*"),
    ("CCBYNCref4.0", r".*licen[cs]ed under (a )?(cc by-nc 4\.0|creative commons attribution-noncommercial 4\.0).*"),
    ("CCBYSAref4.0", r".*licen[cs]ed under (a )?(cc by-sa 4\.0|creative commons attribution-sharealike 4\.0).*"),
    ("CCBYref4.0", r".*licen[cs]ed under (a )?(cc by 4\.0|creative commons attribution 4\.0).*"),
    ("Unlicense", r".*free and unencumbered software released into the public domain.*"),
    ("PublicDomain", r".*(is|are) (hereby )?(placed |released )?in(to)? the public domain"),
    ("OtherLicence", r".*licen[cs]ed under .*"),
)

# Licence and the identifiers that, in this order, make it; earlier rules go first.
RULES = (
    ("Apache-2.0", ("ApacheRef2.0", "ApacheNot", "ApacheObtain", "ApacheAsIs", "ApacheSee")),
    ("Apache-2.0", ("ApacheRef2.0", "ApacheObtain", "ApacheAsIs", "ApacheSee")),
    ("Apache-2.0", ("ApacheRef2.0",)),
    ("MIT", ("MITperm", "MITnotice", "AsIs", "NoLiability")),
    ("MIT", ("MITperm", "MITnotice", "AsIs")),
    ("MIT", ("MITref",)),
    ("ISC", ("ISCperm", "AsIs")),
    ("ISC", ("ISCperm",)),
    ("BSD-3-Clause", ("BSDpre", "BSDsource", "BSDbinary", "BSDname", "BSDasIs")),
    ("BSD-3-Clause", ("BSDpre", "BSDsource", "BSDbinary", "BSDname")),
    ("BSD-2-Clause", ("BSDpre", "BSDsource", "BSDbinary", "BSDasIs")),
    ("BSD-2-Clause", ("BSDpre", "BSDsource", "BSDbinary")),
    ("BSD", ("BSDref",)),
    ("AGPL-3.0", ("AGPLref3", "GPLnoWarranty", "GPLcopy")),
    ("AGPL-3.0", ("AGPLref3",)),
    ("AGPL-3.0", ("AGPLpub", "Version3", "GPLnoWarranty", "GPLcopy")),
    ("AGPL-3.0", ("AGPLpub", "Version3")),
    ("LGPL-2.1", ("LGPLref2.1", "GPLnoWarranty", "GPLcopy")),
    ("LGPL-2.1", ("LGPLref2.1",)),
    ("LGPL-2.1", ("LGPLpub", "Version2.1", "GPLnoWarranty", "GPLcopy")),
    ("LGPL-2.1", ("LGPLpub", "Version2.1")),
    ("LGPL-3.0", ("LGPLref3", "GPLnoWarranty", "GPLcopy")),
    ("LGPL-3.0", ("LGPLref3",)),
    ("LGPL-3.0", ("LGPLpub", "Version3", "GPLnoWarranty", "GPLcopy")),
    ("LGPL-3.0", ("LGPLpub", "Version3")),
    ("GPL-2.0", ("GPLref2", "GPLnoWarranty", "GPLcopy")),
    ("GPL-2.0", ("GPLref2",)),
    ("GPL-2.0", ("GPLpub", "Version2", "GPLnoWarranty", "GPLcopy")),
    ("GPL-2.0", ("GPLpub", "Version2")),
    ("GPL-3.0", ("GPLref3", "GPLnoWarranty", "GPLcopy")),
    ("GPL-3.0", ("GPLref3",)),
    ("GPL-3.0", ("GPLpub", "Version3", "GPLnoWarranty", "GPLcopy")),
    ("GPL-3.0", ("GPLpub", "Version3")),
    ("MPL-2.0", ("MPLref2.0",)),
    ("EPL-2.0", ("EPLref2.0",)),
    ("BSL-1.0", ("BoostRef",)),
    ("Zlib", ("ZlibAsIs", "ZlibOrigin", "ZlibAltered")),
    ("CC0-1.0", ("CC0ref",)),
    ("CC-BY-NC-SA-4.0", ("CCBYNCSAref4.0",)),
    ("CC-BY-NC-4.0", ("CCBYNCref4.0",)),
    ("CC-BY-SA-4.0", ("CCBYSAref4.0",)),
    ("CC-BY-4.0", ("CCBYref4.0",)),
    ("Unlicense", ("Unlicense",)),
    ("Public-Domain", ("PublicDomain",)),
    ("SPDX", ("SPDX",)),
    ("Proprietary", ("Copyright", "AllRights")),
    ("Proprietary", ("AllRights",)),
    ("Unknown", ("OtherLicence",)),
    ("Unknown", ("AGPLpub",)),
    ("Unknown", ("LGPLpub",)),
    ("Unknown", ("GPLpub",)),
)

KEYWORD = f"(?i)({'|'.join(KEYWORDS)})"
# an SPDX identifier and "v. 2.0" are passed over whole, so that their stops do not part them
FULL_STOP = r"((?i:spdx-license-identifier):[ \t]*[^ \t\r\n]*|\b[vV]\.[ \t\r\n]+[0-9][0-9.]*|[.!?;:][ \t\r\n])[ \t\r\n]*"
EMPTY_LINE = r"\n[ \t\r#*/;]*\n"
OPENER = rf"\n[ \t#*/;-]*({'|'.join(OPENERS)})"
QUOTES = "\"'`"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sentences(text):
    """The sentences of a text column that have a keyword. Sentences end at stops, empty lines and before openers."""
    cut = F.regexp_replace(text, FULL_STOP, "$1\u0001")
    cut = F.regexp_replace(F.regexp_replace(cut, EMPTY_LINE, "\u0001"), OPENER, "\u0001$1")
    return F.filter(F.split(cut, "\u0001"), lambda s: s.rlike(KEYWORD))


def normalised(sentence):
    """A-Z in lower case, quotes dropped; all but letters, digits, and ``. , + / ( ) -`` as blanks; neither these nor
    stops at the ends."""
    plain = F.translate(sentence, _UPPER + QUOTES, _LOWER)
    plain = F.regexp_replace(F.regexp_replace(plain, r"[^a-z0-9.,+/()-]+", " "), r"^[ .,/+-]+|[ .,/+-]+$", "")
    return plain


def identifier(sentence):
    """The first known sentence that fits, null for none."""
    found = F
    for name, pattern in SENTENCES:
        found = found.when(sentence.rlike(f"^{pattern}$"), F.lit(name))
    return found


def scan(docs, text="text"):
    """``docs`` with ``sentence_ids`` and ``licences``: known sentences and licences in order, as text joined by blanks.

    A text without a keyword has none (every known sentence has one), so it is not cut. Copyright lines inside a licence
    do not part it. Null and empty texts have none; repeated rows are scanned alike; columns named like those added are
    replaced; an empty table gives an empty one.
    """
    docs = docs.drop("sentence_ids", "licences")
    found = F.when(F.col(text).rlike(KEYWORD), sentences(F.col(text))).otherwise(F.array().cast("array<string>"))
    ids = F.filter(F.transform(found, lambda s: identifier(normalised(s))), lambda s: s.isNotNull())
    docs = docs.withColumn("sentence_ids", F.array_join(ids, " "))
    # a rule is a run of identifiers; at each place the first rule that fits is taken and its run consumed
    runs = list(dict.fromkeys("".join(f"<{name}>" for name in names) for _, names in RULES))
    names = {}
    for licence, ids in RULES:
        names.setdefault("".join(f"<{name}>" for name in ids), licence)
    pattern = "|".join(run.replace(".", r"\.") for run in runs)
    row = F.regexp_replace(F.col("sentence_ids"), "([^ ]+) ?", "<$1>")
    bare = F.regexp_replace(row, r"(<Copyright>)+(<[^A])", "$2")
    matched = F.regexp_extract_all(bare, F.lit(f"({pattern})"), F.lit(1))
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    licences = F.array_distinct(F.transform(matched, lambda run: table[run]))
    return docs.withColumn("licences", F.coalesce(F.array_join(licences, " "), F.lit("")))
