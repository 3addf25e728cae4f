"""Signature rules of the license scan.

A rule is a wording: words in order, ``word?`` optional, with an expression inside a
word where spellings differ (``licen[cs]e``, ``(two|2)``). Most rules come from a
license's names and the versions that were published; the rest are sentences of the
license texts themselves.
"""

import re

#: Code, published versions, long names, short names.
VERSIONED = [
    ("gpl", "1.0 2.0 3.0", ["general public licen[cs]e"], ["gpl"]),
    ("lgpl", "2.0 2.1 3.0", ["(lesser|library) general public licen[cs]e"], ["lgpl"]),
    ("agpl", "1.0 3.0", ["affero general public licen[cs]e"], ["agpl"]),
    ("apache", "1.0 1.1 2.0", ["apache (software)? licen[cs]e"], ["apache", "asl"]),
    ("mpl", "1.0 1.1 2.0", ["mozilla public licen[cs]e"], ["mpl"]),
    ("epl", "1.0 2.0", ["eclipse public licen[cs]e"], ["epl"]),
    ("cddl", "1.0 1.1", ["common development and distribution licen[cs]e"], ["cddl"]),
    ("cpl", "1.0", ["common public licen[cs]e"], ["cpl"]),
    ("ipl", "1.0", ["ibm public licen[cs]e"], ["ipl"]),
    ("artistic", "1.0 2.0", ["artistic licen[cs]e"], ["artistic"]),
    ("gfdl", "1.1 1.2 1.3", ["free documentation licen[cs]e"], ["gfdl"]),
    ("eupl", "1.0 1.1 1.2", ["european union public licen[cs]e"], ["eupl"]),
    ("afl", "1.1 1.2 2.0 2.1 3.0", ["academic free licen[cs]e"], ["afl"]),
    ("osl", "1.0 1.1 2.0 2.1 3.0", ["open software licen[cs]e"], ["osl"]),
    ("ofl", "1.0 1.1", ["sil? open font licen[cs]e"], ["ofl"]),
    ("lppl", "1.0 1.1 1.2 1.3a 1.3c", ["latex project public licen[cs]e"], ["lppl"]),
    ("cecill", "1.0 1.1 2.0 2.1", ["cecill free? software? licen[cs]e"], ["cecill"]),
    ("php", "3.0 3.01", ["php licen[cs]e"], []),
    ("zpl", "1.1 2.0 2.1", ["zope public licen[cs]e"], ["zpl"]),
    ("psf", "2.0", ["python software foundation licen[cs]e"], ["psf"]),
    ("bsl", "1.0", ["boost software licen[cs]e"], []),
    ("busl", "1.1", ["business source licen[cs]e"], ["busl"]),
    ("sspl", "1.0", ["server side public licen[cs]e"], ["sspl"]),
    ("elastic", "2.0", ["elastic licen[cs]e"], []),
    ("upl", "1.0", ["universal permissive licen[cs]e"], ["upl"]),
    ("ecl", "1.0 2.0", ["educational community licen[cs]e"], ["ecl"]),
    ("qpl", "1.0", ["q public licen[cs]e"], ["qpl"]),
    ("rpl", "1.1 1.5", ["reciprocal public licen[cs]e"], ["rpl"]),
    ("spl", "1.0", ["sun public licen[cs]e"], []),
    ("apsl", "1.0 1.1 1.2 2.0", ["apple public source licen[cs]e"], ["apsl"]),
    ("odbl", "1.0", ["open (data)? (commons)? open? database licen[cs]e"], ["odbl"]),
    ("mulanpsl", "1.0 2.0", ["mulan permissive software licen[cs]e"], ["mulanpsl"]),
    ("blueoak", "1.0.0", ["blue oak model licen[cs]e"], []),
    ("cal", "1.0", ["cryptographic autonomy licen[cs]e"], []),
    ("vsl", "1.0", ["vovida software licen[cs]e"], []),
    ("cpal", "1.0", ["common public attribution licen[cs]e"], ["cpal"]),
]
#: Short names that are written with their version as one word.
JOINED = ("gpl", "lgpl", "agpl", "gfdl", "mpl", "epl", "cddl", "eupl", "apache", "asl")
#: Families whose licenses offer later versions; the first three have a file header.
LATER = ("gpl", "lgpl", "agpl", "gfdl")
HEADER = (
    "as published by the free software foundation either version {number} of the"
    " licen[cs]e or at your option any later version"
)

#: Code, sentences of the license or its notice (at least seven words
#: of text are decisive), and names.
UNVERSIONED = [
    ("mit", [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "(licensed|released|available|distributed) under the? terms? of? the? mit licen[cs]e",
        "the? mit licen[cs]e", "mit x11 licen[cs]e", "mit style licen[cs]e", "expat licen[cs]e",
    ]),
    ("mit-0", ["mit no attribution licen[cs]e", "mit 0 licen[cs]e"]),
    ("isc", [
        "permission to use copy modify and or? distribute this software for any purpose with or without fee is hereby granted",
        "the? isc licen[cs]e",
    ]),
    ("0bsd", ["zero clause bsd", "bsd zero clause licen[cs]e", "0bsd licen[cs]e"]),
    ("bsd-1-clause", ["bsd (1|one) clause", "(1|one) clause bsd"]),
    ("bsd-2-clause", ["bsd (2|two) clause", "(2|two) clause bsd", "simplified bsd licen[cs]e", "freebsd licen[cs]e"]),
    ("bsd-3-clause", [
        "may be used to endorse or promote products derived from this software without specific prior written permission",
        "bsd (3|three) clause", "(3|three) clause bsd", "new bsd licen[cs]e", "modified bsd licen[cs]e", "revised bsd licen[cs]e",
    ]),
    ("bsd-4-clause", [
        "all advertising materials mentioning features or use of this software must display the following acknowledgement",
        "bsd (4|four) clause", "(4|four) clause bsd", "original bsd licen[cs]e",
    ]),
    ("bsd", [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "redistributions in binary form must reproduce the above copyright notice",
        "(licensed|released|available|distributed) under the? terms? of? the? bsd licen[cs]e",
        "the? bsd licen[cs]e", "bsd style licen[cs]e",
    ]),
    ("apache", [
        "licensed under the apache licen[cs]e", "apache licen[cs]e",
        "unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis",
    ]),
    ("gpl", [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e",
        "you should have received a copy of the gnu general public licen[cs]e along with this program",
        "gnu? general public licen[cs]e", "gnu gpl", "gpl licen[cs]e", "licensed under the gpl",
    ]),
    ("lgpl", [
        "this library is free software you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public licen[cs]e",
        "gnu? (lesser|library) general public licen[cs]e", "gnu lgpl", "lgpl licen[cs]e", "licensed under the lgpl",
    ]),
    ("agpl", ["gnu? affero general public licen[cs]e", "gnu agpl", "agpl licen[cs]e", "licensed under the agpl"]),
    ("mpl", [
        "this source code form is subject to the terms of the mozilla public licen[cs]e",
        "if a copy of the mpl was not distributed with this file you can obtain one at", "mozilla public licen[cs]e",
    ]),
    ("epl", [
        "this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e",
        "eclipse public licen[cs]e",
    ]),
    ("gfdl", ["permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e", "gnu free documentation licen[cs]e"]),
    ("zlib", [
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages",
        "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
        "zlib licen[cs]e", "zlib libpng licen[cs]e",
    ]),
    ("bsl-1.0", ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[cs]e", "boost software licen[cs]e"]),
    ("unlicense", [
        "this is free and unencumbered software released into the public domain",
        "anyone is free to copy modify publish use compile sell or distribute this software", "the? unlicense",
    ]),
    ("wtfpl", ["do what the fuck you want to public licen[cs]e", "wtfpl"]),
    ("public-domain", [
        "(released|placed|dedicated|put) (into|in|to) the public domain",
        "in the public domain", "public domain dedication",
    ]),
    ("cc0-1.0", [
        "the person who associated a work with this deed has dedicated the work to the public domain",
        "cc0 1 0 universal?", "creative commons zero", "cc0", "creativecommons org publicdomain zero 1 0",
    ]),
    ("cc", ["licensed under a creative commons", "creative commons licen[cs]e"]),
    ("all-rights-reserved", ["all rights reserved"]),
    ("proprietary", [
        "this software is the confidential and proprietary information of",
        "unauthorized copying of this file via any medium is strictly prohibited",
        "proprietary and confidential", "proprietary licen[cs]e", "commercial licen[cs]e",
    ]),
    ("psf", ["python software foundation licen[cs]e", "psf licen[cs]e", "licensed to psf under a contributor agreement"]),
    ("ofl", ["this font software is licensed under the sil open font licen[cs]e", "sil? open font licen[cs]e"]),
    ("postgresql", ["permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "postgresql licen[cs]e"]),
    ("openssl", ["this product includes software developed by the openssl project for use in the openssl toolkit", "openssl licen[cs]e"]),
    ("artistic", ["(under|on) the same terms as perl itself", "same terms as perl", "artistic licen[cs]e"]),
    ("ms-pl", ["microsoft public licen[cs]e", "ms pl"]),
    ("ms-rl", ["microsoft reciprocal licen[cs]e", "ms rl"]),
    ("ncsa", ["university of illinois ncsa open source licen[cs]e", "ncsa open source licen[cs]e"]),
    ("w3c", ["w3c software notice and licen[cs]e", "w3c software and document notice and licen[cs]e", "w3c licen[cs]e"]),
    ("ruby", ["ruby licen[cs]e", "same licen[cs]e as ruby"]),
    ("vim", ["vim licen[cs]e", "vim charityware"]),
    ("curl", ["curl licen[cs]e"]),
    ("icu", ["icu licen[cs]e"]),
    ("unicode", ["unicode terms of use", "unicode licen[cs]e agreement", "unicode licen[cs]e"]),
    ("x11", ["x11 licen[cs]e", "x consortium licen[cs]e"]),
    ("hpnd", ["historical permission notice and disclaimer"]),
    ("beerware", ["as long as you retain this notice you can do whatever you want with this stuff", "beerware licen[cs]e", "beer ware licen[cs]e"]),
    ("json", ["the software shall be used for good not evil", "json licen[cs]e"]),
    ("sleepycat", ["sleepycat licen[cs]e"]),
    ("tcl", ["tcl licen[cs]e", "tcl tk licen[cs]e"]),
    ("ijg", ["independent jpeg group licen[cs]e", "based in part on the work of the independent jpeg group"]),
    ("libpng", ["libpng licen[cs]e", "png reference library licen[cs]e"]),
    ("freetype", ["freetype project licen[cs]e", "freetype licen[cs]e"]),
    ("imagemagick", ["imagemagick licen[cs]e"]),
    ("intel", ["intel open source licen[cs]e", "intel simplified software licen[cs]e"]),
    ("naist", ["naist licen[cs]e"]),
    ("odc-by", ["open data commons attribution licen[cs]e", "odc by"]),
    ("pddl", ["open data commons public domain dedication and licen[cs]e", "pddl"]),
    ("commons-clause", ["commons clause licen[cs]e condition", "commons clause"]),
    ("polyform", ["polyform noncommercial licen[cs]e", "polyform small business licen[cs]e", "polyform shield licen[cs]e"]),
    ("hippocratic", ["hippocratic licen[cs]e"]),
    ("openrail", ["responsible ai licen[cs]e", "bigscience rail licen[cs]e", "creativeml open rail m", "openrail m?"]),
    ("open-government", ["open government licen[cs]e", "ogl v?[123]"]),
    ("etalab", ["etalab open licen[cs]e", "licence ouverte"]),
    ("eupl", ["european union public licen[cs]e"]),
    ("classpath-exception", ["gpl with classpath exception", "linking this library statically or dynamically with other modules is making a combined work based on this library"]),
    ("gcc-exception", ["gcc runtime library exception"]),
    ("llvm-exception", ["apache licen[cs]e with llvm exceptions", "llvm exceptions"]),
]
#: Parts of the license family of Creative Commons.
SHARING = {"": "", "share ?alike": "-sa", "no ?derivatives": "-nd"}
NONCOMMERCIAL = {"": "", "non ?commercial": "-nc"}
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def _number(version: str) -> str:
    """``2.0`` is written 2, 2.0, v2 and v2.0."""
    first, *rest = version.split(".")
    return " ".join([f"v?{first}", *(f"{r}?" if r == "0" else r for r in rest)])


def _words(code: str) -> str:
    return " ".join(re.findall("[a-z0-9]+", code))


def _tokens(wording: str) -> list[tuple[str, bool]]:
    """Words with whether each is optional; an optional word may be a choice."""
    return [(w.removesuffix("?"), w.endswith("?")) for w in wording.split()]


def _pattern(wording: str, one, gap: str) -> str:
    made, begun = "", False
    for word, optional in _tokens(wording):
        if begun:
            made += f"(?:{gap}{one(word)})?" if optional else gap + one(word)
        else:
            made += f"(?:{one(word)}{gap})?" if optional else one(word)
            begun = not optional
    return made


def _alternatives(wording: str) -> list[str]:
    """``non ?x`` as both ``non x`` and ``nonx``."""
    if " ?" in wording:
        return _alternatives(wording.replace(" ?", " ", 1)) + _alternatives(
            wording.replace(" ?", "", 1)
        )
    return [wording]


def _family(code: str, version: str, names: list[str], shorts: list[str]):
    """``label, priority, weight, wording`` of one version of a license."""
    number = _number(version)
    label = f"{code}-{version.removesuffix('.0') if code in LATER else version}"
    long = [f"{n} (version|v)? {number}" for n in names]
    short = [f"{s} (version|v)? {number}" for s in shorts]
    joined = [s for s in shorts if s in JOINED]
    short += [f"{s}{number.replace('v?', v)}" for s in joined for v in ("v", "")]
    of_name = [f"version {number} of the gnu? {n}" for n in names]
    for wording in [*long, *of_name]:
        yield label, 80, 0.95, wording
    for wording in short:
        yield label, 70, 0.85, wording
    if code == "apache":
        yield label, 80, 0.95, f"apache org licen[cs]es licen[cs]e {number}"
        yield label, 80, 0.95, f"apache {number} licen[cs]e"
    if code in LATER:
        later = f"{label}-or-later"
        for wording in [*long, *of_name, *short]:
            for tail in ("or later", "or any later version", "or at your option any later version"):
                yield later, 90, 0.98, f"{wording} {tail}"
        for name in names:
            yield later, 90, 0.98, f"{name} {HEADER.format(number=number)}"
        for end, of in (("or later", later), ("only", label), ("", label)):
            words = f"spdx licen[cs]e identifier {code} {number} {end}"
            yield of, 95, 1.0, words
    else:
        yield label, 95, 1.0, f"spdx licen[cs]e identifier {code} {number}"


def _commons():
    for version in COMMONS_VERSIONS:
        for limit, nc in NONCOMMERCIAL.items():
            for part, tail in SHARING.items():
                label = f"cc-by{nc}{tail}-{version}"
                major, minor = version.split(".")
                for words in _alternatives(f"{limit} {part}"):
                    name = f"creative commons attribution {words}"
                    yield label, 80, 0.95, f"{name} licen[cs]e? version? {major} {minor} (international|generic|unported)?"
                short = _words(f"cc by{nc}{tail}")
                yield label, 70, 0.9, f"{short} {major} {minor}"
                yield label, 95, 1.0, f"spdx licen[cs]e identifier {short} {major} {minor}"
                link = f"licen[cs]es by {_words(nc + tail)} {major} {minor}"
                yield label, 80, 0.95, f"creativecommons org {link}"


def _plain():
    for code, wordings in UNVERSIONED:
        for place, given in enumerate(wordings):
            for wording in _alternatives(given):
                long = len(wording.split()) > 6
                yield code, 60 if long else 40 - place, 0.9 if long else 0.7, wording
        yield code, 95, 1.0, f"spdx licen[cs]e identifier {_words(code)}"


def _tree(words: list[str]) -> str:
    """One expression for all words, branching where they differ."""
    words = sorted(set(words))
    if "" in words:
        return ""  # the shorter word is a beginning of the others
    heads: dict[str, list[str]] = {}
    for word in words:
        heads.setdefault(word[0], []).append(word[1:])
    branches = [head + _tree(tails) for head, tails in heads.items()]
    return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"


def _literal(word: str) -> str:
    """A plain word with a space behind, or what every spelling of it begins with."""
    if word.isalnum():
        return word + " "
    return re.split(r"[^a-z0-9]|[a-z0-9](?=\?)", word)[0]


def _rules() -> list[dict]:
    """``rule, anchor, keyword, label, priority, level, weight, needs, pattern, numbered``.

    ``pattern`` matches words with a space of their own at both ends, ``numbered``
    words that are followed by a colon and their number. Anchor and keyword are the
    beginnings of the words of the wording that most and fewest rules have; ``needs``
    are words it cannot do without.
    """
    made = [r for family in VERSIONED for v in family[1].split() for r in _family(family[0], v, *family[2:])]
    made += [*_commons(), *_plain()]
    levels = sorted({r[1] for r in made})
    starts: dict[str, int] = {}
    required = []
    for *_, wording in made:
        words = [w for w, optional in _tokens(wording) if not optional]
        required.append(words)
        for start in {_literal(w) for w in words}:
            starts[start] = starts.get(start, 0) + 1
    rules = []
    for (label, priority, weight, wording), words in zip(made, required, strict=True):
        fixed = [w for w in words if w.isalnum()]
        begun = [s for s in map(_literal, words) if len(s.strip()) > 1]
        named = [s for s in begun if s.strip() not in COMMON] or begun
        longer = [s for s in named if len(s.strip()) > 2]
        rules.append(
            {
                "rule": len(rules),
                "anchor": max(longer or named, key=lambda s: (starts[s], s)),
                "keyword": min(longer or named, key=lambda s: (starts[s], s)),
                "label": label,
                "priority": priority,
                "level": levels.index(priority),
                "weight": weight,
                "needs": fixed,
                "pattern": f" {_pattern(wording, str, '  ')} ",
                "numbered": f"(?<= ){_pattern(wording, lambda w: w + ':[0-9]+', ' ')}(?= )",
            }
        )
    anchors = {r["anchor"] for r in rules}
    for rule in rules:
        # A beginning of another anchor stands for it.
        rule["anchor"] = min(a for a in anchors if rule["anchor"].startswith(a))
    return rules


#: Words that are too frequent in any text to gate a rule.
COMMON = frozenset(
    "of to in is on or be as by at an the and for with this that you any are all can from may not was will use used one two"
    " three four version free open under new software library source data model project"
    " must without same file org shall notice modify above following form provided person"
    " whatever conditions make makes made charge permitted agreed along"
    " later via want rights original materials distribute binary warranty written list forms"
    " distributed distribution copies copying information written available into its have"
    " long small condition subject fee into derived covered applicable agreement attribution"
    " your sell versions liable permission copyright exception clause documentation"
    " general option either only"
    " terms work works people copy public common commons good group university simple based part".split()
)
RULES = _rules()
LEVELS = max(r["level"] for r in RULES) + 1
ANCHORS = sorted({r["anchor"] for r in RULES})
#: A text without an anchor matches no rule. Most words fail by their first two letters.
FIRST, SECOND = ("".join(sorted({a[i] for a in ANCHORS})) for i in (0, 1))
GATE = f" (?=[{FIRST}][{SECOND}]){_tree(ANCHORS)}"
