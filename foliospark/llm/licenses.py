"""Licence scans by sentence rules, in DataFrame functions.

Texts are cut into pieces (at line ends and after . ! ? ; : and a space), which
are normalised (marks of comments go) and looked up among known licence
sentences. Pieces that make a known sentence only together, up to a blank line,
are joined, so sentences may be wrapped; 'this file is', the number of an item and
the like may stand before one. The sequence of identifiers found is matched
against ordered rules, longer and more specific ones first; what a rule matches is
used up.

Defined results: null or empty text has no sentence and no licence; a null id
stays; repeated rows repeat; very long texts are scanned whole; of two rules that
match at the same place the earlier one wins; an empty table gives an empty table;
other columns are ignored. Known sentences that no rule uses are reported in
``unmatched``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import table, text_or_empty

#: Known licence sentences (normalised) and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "ApacheRef",
    "licensed under the apache license version 2 0 the license": "ApacheRef",
    "you may not use this file except in compliance with the license": "ApacheUse",
    "you may obtain a copy of the license at": "ApacheCopy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ApacheAsIs",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "released under the mit license": "MITRef",
    "licensed under the mit license": "MITRef",
    "distributed under the mit license": "MITRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITAsIs",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDEndorse",
    "this work is licensed under the gnu general public license version 3": "GPL3Ref",
    "this work is licensed under the gnu general public license version 2": "GPL2Ref",
    "licensed under the gnu general public license version 3": "GPL3Ref",
    "licensed under the gnu general public license version 2": "GPL2Ref",
    "this program is free software": "FreeSoftware",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3Later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2Later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPLWarranty",
    "see the gnu general public license for more details": "GPLSee",
    "licensed under the gnu lesser general public license version 3": "LGPL3Ref",
    "licensed under the mozilla public license version 2 0": "MPLRef",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPLForm",
    "licensed under cc by 4 0": "CCBYRef",
    "licensed under cc by sa 4 0": "CCBYSARef",
    "licensed under cc by nc 4 0": "CCBYNCRef",
    "licensed under cc by nd 4 0": "CCBYNDRef",
    "licensed under cc by nc sa 4 0": "CCBYNCSARef",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCBYRef",
    "this work is dedicated to the public domain": "PublicDomain",
    "all rights reserved": "AllRights",
    "neither the name of the author nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDEndorse",
    "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission": "BSDEndorse",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BSDAsIs",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "BSDLiable",
    "in no event shall the copyright owner or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "BSDLiable",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MITLiable",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "ISCAsIs",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "ZeroBSDGrant",
    "this software is provided as is without any express or implied warranty": "ZlibAsIs",
    "in no event will the authors be held liable for any damages arising from the use of this software": "ZlibLiable",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "ZlibGrant",
    "this is free and unencumbered software released into the public domain": "UnlicenseRef",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "UnlicenseGrant",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "BoostGrant",
    "distributed under the boost software license version 1 0": "BoostRef",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "AGPL3Later",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "LGPL3Later",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "LGPL21Later",
    "this library is free software": "FreeSoftware",
    "licensed under the gnu affero general public license version 3": "AGPL3Ref",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0": "EPLRef",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0": "EPLRef",
    "if a copy of the mpl was not distributed with this file you can obtain one at": "MPLCopy",
    "spdx license identifier mit": "MITRef",
    "spdx license identifier apache 2 0": "ApacheRef",
    "spdx license identifier bsd 2 clause": "BSD2Ref",
    "spdx license identifier bsd 3 clause": "BSD3Ref",
    "spdx license identifier isc": "ISCRef",
    "spdx license identifier zlib": "ZlibRef",
    "spdx license identifier unlicense": "UnlicenseRef",
    "spdx license identifier bsl 1 0": "BoostRef",
    "spdx license identifier mpl 2 0": "MPLRef",
    "spdx license identifier epl 2 0": "EPLRef",
    "spdx license identifier gpl 2 0 only": "GPL2Ref",
    "spdx license identifier gpl 2 0 or later": "GPL2Later",
    "spdx license identifier gpl 3 0 only": "GPL3Ref",
    "spdx license identifier gpl 3 0 or later": "GPL3Later",
    "spdx license identifier lgpl 2 1 or later": "LGPL21Later",
    "spdx license identifier lgpl 3 0 only": "LGPL3Ref",
    "spdx license identifier lgpl 3 0 or later": "LGPL3Later",
    "spdx license identifier agpl 3 0 only": "AGPL3Ref",
    "spdx license identifier agpl 3 0 or later": "AGPL3Later",
    "spdx license identifier cc by 4 0": "CCBYRef",
    "spdx license identifier cc by sa 4 0": "CCBYSARef",
}
#: Ordered rules, from identifier sequences to licences.
RULES = (
    (("ApacheRef", "ApacheUse", "ApacheCopy", "ApacheAsIs", "ApacheSee"), "Apache-2.0"),
    (("ApacheRef", "ApacheUse", "ApacheCopy"), "Apache-2.0"),
    (("MITGrant", "MITNotice", "MITAsIs", "MITLiable"), "MIT"),
    (("MITGrant", "MITNotice", "MITAsIs"), "MIT"),
    (("MITGrant", "MITNotice"), "MIT"),
    (("BSDGrant", "BSDSource", "BSDBinary", "BSDEndorse", "BSDAsIs", "BSDLiable"), "BSD-3-Clause"),
    (("BSDGrant", "BSDSource", "BSDBinary", "BSDAsIs", "BSDLiable"), "BSD-2-Clause"),
    (("BSDGrant", "BSDSource", "BSDBinary", "BSDEndorse"), "BSD-3-Clause"),
    (("BSDGrant", "BSDSource", "BSDBinary"), "BSD-2-Clause"),
    (("FreeSoftware", "GPL3Later", "GPLWarranty", "GPLSee"), "GPL-3.0-or-later"),
    (("FreeSoftware", "GPL2Later", "GPLWarranty", "GPLSee"), "GPL-2.0-or-later"),
    (("FreeSoftware", "GPL3Later"), "GPL-3.0-or-later"),
    (("FreeSoftware", "GPL2Later"), "GPL-2.0-or-later"),
    (("FreeSoftware", "AGPL3Later"), "AGPL-3.0-or-later"),
    (("FreeSoftware", "LGPL3Later"), "LGPL-3.0-or-later"),
    (("FreeSoftware", "LGPL21Later"), "LGPL-2.1-or-later"),
    (("ISCGrant", "ISCAsIs"), "ISC"),
    (("ZeroBSDGrant", "ISCAsIs"), "0BSD"),
    (("ZlibAsIs", "ZlibLiable", "ZlibGrant"), "Zlib"),
    (("UnlicenseRef", "UnlicenseGrant"), "Unlicense"),
    (("MPLForm", "MPLCopy"), "MPL-2.0"),
    (("BoostGrant",), "BSL-1.0"),
    (("BoostRef",), "BSL-1.0"),
    (("ISCGrant",), "ISC"),
    (("ISCRef",), "ISC"),
    (("ZlibRef",), "Zlib"),
    (("UnlicenseRef",), "Unlicense"),
    (("BSD3Ref",), "BSD-3-Clause"),
    (("BSD2Ref",), "BSD-2-Clause"),
    (("EPLRef",), "EPL-2.0"),
    (("AGPL3Later",), "AGPL-3.0-or-later"),
    (("AGPL3Ref",), "AGPL-3.0-only"),
    (("LGPL3Later",), "LGPL-3.0-or-later"),
    (("LGPL21Later",), "LGPL-2.1-or-later"),
    (("GPL3Later",), "GPL-3.0-or-later"),
    (("GPL2Later",), "GPL-2.0-or-later"),
    (("GPL3Ref",), "GPL-3.0-only"),
    (("GPL2Ref",), "GPL-2.0-only"),
    (("LGPL3Ref",), "LGPL-3.0-only"),
    (("MPLRef",), "MPL-2.0"),
    (("MPLForm",), "MPL-2.0"),
    (("ApacheRef",), "Apache-2.0"),
    (("MITRef",), "MIT"),
    (("CCBYNCSARef",), "CC-BY-NC-SA-4.0"),
    (("CCBYNCRef",), "CC-BY-NC-4.0"),
    (("CCBYNDRef",), "CC-BY-ND-4.0"),
    (("CCBYSARef",), "CC-BY-SA-4.0"),
    (("CCBYRef",), "CC-BY-4.0"),
    (("PublicDomain",), "PublicDomain"),
    (("AllRights",), "Proprietary"),
)
#: Every known sentence holds one of these; other texts have no known sentence.
TRIGGERS = ("licen", "permission", "copyright", "redistribut", "public domain", "rights reserved", "free software", "warrant", "promote products", "liable", "anyone is free", "mpl was not")


#: Words, or the number of an item, that may stand before a known sentence.
LEAD = r"^(?:(?:this|the) (?:file|project|software|work|source code|source|code|program|package|library|document|module) is|[0-9]{1,2}|[a-z]) "
_ALL = "|" + "|".join(SENTENCES) + "|"


def _pieces(text: Column) -> Column:
    """Normalised pieces: cut at line ends and after . ! ? ; and a space; a
    blank line is an empty piece."""
    cut = F.split(F.regexp_replace(F.lower(text), r"([.!?;:])[ \t]+", "$1\n"), r"\n")
    return F.transform(cut, lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))


def _found(pieces: Column, known: Column) -> Column:
    """Identifiers of known sentences, each of one piece or of several."""
    none = F.array().cast("array<string>")
    zero = F.struct(none.alias("open"), none.alias("ids"))
    is_known = lambda c: F.element_at(known, c).isNotNull()

    def step(acc: Column, x: Column) -> Column:
        longer = F.concat(F.transform(acc["open"], lambda c: F.concat(c, F.lit(" "), x)), F.array(x, F.regexp_replace(x, LEAD, "")))
        # the beginnings of known sentences, the longest first
        going = F.filter(longer, lambda c: F.contains(F.lit(_ALL), F.concat(F.lit("|"), c, F.lit(" "))))
        whole = F.filter(longer, is_known)
        hit = F.size(whole) > 0
        after = F.struct(F.when(hit, none).otherwise(going).alias("open"), F.when(hit, F.concat(acc["ids"], F.array(F.element_at(known, F.get(whole, 0))))).otherwise(acc["ids"]).alias("ids"))
        return F.when(x == "", F.struct(none.alias("open"), acc["ids"].alias("ids"))).otherwise(after)

    return F.aggregate(pieces, zero, step, lambda acc: acc["ids"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, sentence_ids, licenses, unmatched`` for every row; no shuffle."""
    known = F.create_map(*(F.lit(x) for pair in SENTENCES.items() for x in pair))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("t"))
    hopeful = F.lower("t").rlike("|".join(TRIGGERS))
    ids = _found(_pieces(F.col("t")), known)
    found = rows.select("doc_id", F.when(hopeful, F.array_join(ids, " ")).otherwise("").alias("sentence_ids"))
    state = found.withColumn("_rest", F.concat(F.lit(" "), F.regexp_replace("sentence_ids", " ", "  "), F.lit(" "))).withColumn("licenses", F.lit(""))
    for sequence, name in RULES:
        part = " " + "  ".join(sequence) + " "
        hit = F.contains("_rest", F.lit(part))
        # two licences by one rule are one finding
        named = F.when(hit & ~F.contains(F.concat(F.lit(","), "licenses", F.lit(",")), F.lit(f",{name},")), F.concat_ws(",", F.when(F.col("licenses") != "", F.col("licenses")), F.lit(name))).otherwise(F.col("licenses"))
        state = state.withColumns({"licenses": named, "_rest": F.replace("_rest", F.lit(part), F.lit(" "))})
    return state.select("doc_id", "sentence_ids", "licenses", F.trim(F.regexp_replace("_rest", " +", " ")).alias("unmatched"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    known = ", ".join(f"'{k}': '{v}'" for k, v in SENTENCES.items())
    steps, last = [], "s0"
    for k, (sequence, name) in enumerate(RULES, 1):
        part = " " + "  ".join(sequence) + " "
        steps.append(f"""s{k} AS (SELECT doc_id, sentence_ids, replace(rest, '{part}', ' ') AS rest,
  CASE WHEN contains(rest, '{part}') AND NOT contains(',' || licenses || ',', ',{name},') THEN CASE WHEN licenses = '' THEN '' ELSE licenses || ',' END || '{name}' ELSE licenses END AS licenses FROM {last})""")
        last = f"s{k}"
    return f"""
WITH cut AS (SELECT doc_id, regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '([.!?;:])[ \\t]+', '\\1\n', 'g'), '\n+') AS s FROM documents),
ids AS (SELECT doc_id, list_filter(list_transform(s, lambda x: (MAP {{{known}}})[trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g'))]), lambda y: y IS NOT NULL) AS f FROM cut),
s0 AS (SELECT doc_id, coalesce(array_to_string(f, ' '), '') AS sentence_ids, ' ' || coalesce(array_to_string(f, '  '), '') || ' ' AS rest, '' AS licenses FROM ids),
{", ".join(steps)}
SELECT doc_id, sentence_ids, licenses, trim(regexp_replace(rest, ' +', ' ', 'g')) AS unmatched FROM {last}
"""


QUERIES = {"op2_license_scan": op2_license_scan}
ORACLES = {"op2_license_scan": _oracle()}
