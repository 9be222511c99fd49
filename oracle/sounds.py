"""Phonetic codes as SQL for a second engine: a recursive walk over the distinct words.

At each step a word is in two parts, what was read and what is to come.  The table says what is
heard, by sound; of the lines that fit a place the one of least rank holds.
"""

from __future__ import annotations

import re

# Double Metaphone as published by Lawrence Philips (C/C++ Users Journal, June
# 2000), by what is heard, as regular expressions with the letters read between < and >.  Behind
# them: `but`, what must not be read or come; `if`, what the word must be.  As specified, accents
# are dropped, B is P, and a W before H at the start is A.
TABLE = """
silence
  1 ^<G>N
  1 ^<K>N
  1 ^<P>[NS]
  1 ^<W>R
  3 (B|D|H).<GH>
  3 (B|D|H)..<GH>
  3 (B|H)...<GH>
  6 <G>H
  8 <JJ>
  9 <J>
  9 <H>
  1 (I|Y)<S>L
  9 <W>
  2 (A|O)U<X>$
  9 <[AEIOUY]>
A
  1 ^<[AEIOUY]>
  3 ^<W>H
F
  8 <FF>
  9 <F>
  4 (C|G|L|R|T).U<GH>
  1 <PH>
  8 <VV>
  9 <V>
H
  1 <JJ> if ^SAN( |$)
  2 <J> if ^SAN( |$)
  3 ^<J>OSE( |$)
  1 (^|[AEIOUY])<H[AEIOUY]>
J
  1 <DG[EIY]>
  1 ^<GH>I
  5 <GI>ER( |$)
  7 <JJ> but (S|K|L)<JJ>
  8 <J> but (S|K|L)<J> but <J>(L|T|K|S|N|M|B|Z)
  1 <ZHZ>
  2 <ZH>
K
  1 BA<CH>ER
  1 MA<CH>ER
  1 OR<CH>ES
  1 OR<CH>ID
  1 AR<CH>IT
  2 <CH>IA
  2 ^<CH>ARAC
  2 ^<CH>ARIS
  2 ^<CH>YM
  2 ^<CH>EM
  2 ^<CH>OR but <CH>ORE
  2 [^AEIOUY]A<CH> but <CH>(E|I)
  4 <CH> if ^(VAN |VON |SCH)
  4 <CH>(T|S)
  4 (^|A|E|O|U)<CH>(L|R|N|M|B|H|F|V|W| |$)
  5 <CH> if ^MC
  5 <CC> but ^M<CC>
  6 <C[GKQ]>
  7 <C [CGQ]>
  7 <CC> but <CC>(E|I)
  9 <C>
  1 [^AEIOUY]<GH>
  2 ^<GH>
  5 <GH> but I<GH>
  4 <G[EIY]> if ^(VAN |VON |SCH)
  4 (A|O)<GG>I if ^(VAN |VON |SCH)
  4 <GE>T
  8 <GG>
  9 <G>
  8 <KK>
  9 <K>
  8 <QQ>
  9 <Q>
KN
  3 <GN>
KS
  3 U<CCE>(E|S)
  8 <X[CX]>
  9 <X>
L
  8 <LL>
  9 <L>
M
  1 U<MB>($|ER)
  8 <MM>
  9 <M>
N
  8 <NN>
  9 <N>
P
  8 <BB>
  9 <B>
  8 <P[BP]>
  9 <P>
R
  1 <WR> but ^<WR>
  8 <RR>
  9 <R>
S
  1 ^<CA>ESAR
  7 <C[EIY]>
  2 <SH>(EIM|OEK|OLM|OLZ)
  4 <SI[AO]>
  6 <SC[EIY]>
  8 <SS>
  9 <S>
  1 ^<X>
  8 <ZZ>
  9 <Z>
SK
  5 <SCH>(EM|ED|OO|UY)
  7 <SC.>
  8 <SC>
T
  8 <D[DT]>
  9 <D>
  1 <TH>(AM|OM)
  2 <T[TH]> but <TT>([^H]|$) if ^(VAN |VON |SCH)
  8 <T[DT]>
  9 <T>
TK
  2 <DG>
X
  2 <CCI>A
  4 <CC[EHI]> but ^M<CC> but <CCH>U
  5 ^<CH>
  3 <SH>
  6 <SCH>
  1 <TIO>N
  1 <TIA>
  1 <TCH>
0 or T
  3 <T[TH]> but <TT>([^H]|$)
A or F
  2 ^<W>[AEIOUY]
none or F
  4 [AEIOUY]<W>$
  4 (E|O)<W>(SKI|SKY)
  5 <W> if ^SCH
J or none
  6 <J>$
J or A
  4 ^<JJ>
  5 ^<J>
J or H
  3 <J>OSE
  5 [AEIOUY]<J>(A|O) not W|K|CZ
J or K
  6 <G[EIY]>
  6 (A|O)<GG>I
K or J
  2 ^<G[EIY]> but <GE>([^SPBLYIR]|$) but <GI>([^BELN]|$)
  3 <GE>R but (E|I)<GE> not ^(DANGER|RANGER|MANGER)
  3 <GY> but (E|I|R|O)<GY> not ^(DANGER|RANGER|MANGER)
K or X
  3 <CH>AE but ^<CH>
KL or L
  1 <GL>I not W|K|CZ
KN or N
  1 ^[AEIOUY]<GN> not W|K|CZ
L or none
  1 I<LL>(A|O)$
  1 A<LL>E$
  1 A<LL>E.*(A|O|AS|OS)$
N or KN
  2 <GN> but <GN>EY not W|K|CZ
none or R
  1 IE<R>$ but (ME|MA)IE<R> not W|K|CZ
none or S
  1 (A|O)I<S>$
S or TS
  3 <ZZ>[AIO]( |$)
  4 <ZZ> but (^|T)<ZZ> if W|K|CZ
  5 <Z> but (^|T)<Z> if W|K|CZ
S or X
  2 <CZ> but WI<CZ>
  6 <CI>(A|E|O)
  3 <SI[AO]> not W|K|CZ
  3 ^<S>(L|M|N|W)
  4 <SZ>
TS or FX
  6 <WI[CT]Z>
X or K
  6 <CH>
X or S
  1 ^<S>UGAR
  5 ^<SCH> but <SCH>[AEIOUYW]
X or SK
  4 <SCH>(ER|EN)
"""


def fits(pattern: str) -> str:
    """Whether the two parts of a word stand around the letters between < and >."""
    read, letters, comes = re.fullmatch(r"(.*)<(.*)>(.*)", pattern).groups()
    tests = [f"regexp_matches(r, '^{letters}({comes})')"] + [f"regexp_matches(l, '({read})$')"] * bool(read)
    return f"({' AND '.join(tests)})"


def lines() -> list[tuple[int, str, str, str, int]]:
    """(rank, test, primary, secondary, letters read)"""
    out, heard = [], ("", "")
    for text in TABLE.strip().splitlines():
        if not text.startswith("  "):
            first, _, second = text.partition(" or ")
            heard = [x.replace("none", "").replace("silence", "") for x in (first, second or first)]
            continue
        rank, rest = re.fullmatch(r"  (\d) (.*)", text).groups()
        parts = re.split(r" (but|if|not) ", rest)
        tests = []
        for kind, pattern in zip(parts[1::2], parts[2::2]):
            test = fits(pattern) if kind == "but" else f"regexp_matches(whole, '{pattern}')"
            tests.append(test if kind == "if" else f"NOT {test}")
        letters = re.sub(r"\[.*?\]", "x", re.search("<(.*)>", parts[0]).group(1))
        out.append((int(rank), " AND ".join([fits(parts[0]), *tests]), *heard, len(letters)))
    return sorted(out, key=lambda x: x[0])


def codes_ctes(words: str, name: str = "codes") -> list[str]:
    """CTEs up to name(word, code_primary, code_secondary) of the words of a query with a column word."""
    cases = " ".join(f"WHEN {test} THEN {{'p': '{p}', 's': '{s}', 'n': {n}}}" for _, test, p, s, n in lines())
    heard = f"CASE {cases} ELSE {{'p': '', 's': '', 'n': 1}} END"
    return [
        f"{name}_walk(word, whole, l, r, p, s) AS (SELECT word, x, '', x, '', '' FROM (SELECT word, "
        f"upper(strip_accents(replace(word, 'ß', 's'))) AS x FROM ({words})) UNION ALL SELECT word, whole, "
        "substr(whole, 1, length(l) + h.n), substr(whole, length(l) + h.n + 1), p || h.p, s || h.s FROM ("
        f"SELECT *, {heard} AS h FROM {name}_walk WHERE r <> ''))",
        f"{name} AS (SELECT word, p AS code_primary, s AS code_secondary FROM {name}_walk WHERE r = '')"]


def name_codes_sql() -> str:
    words = r"SELECT DISTINCT unnest(regexp_extract_all(text, '\p{L}+')) AS word FROM documents"
    return ("WITH RECURSIVE " + ", ".join(codes_ctes(words)) + " SELECT word, code_primary, code_secondary, CASE WHEN "
            "code_primary = code_secondary THEN code_primary WHEN code_primary IS NULL THEN NULL "
            "ELSE code_primary || ';' || code_secondary END AS code FROM codes")


def duplicates_sql(ctes: list[str], registry: str, days: int = 366) -> str:
    """Members of a block and its first client, once per pair; registry: the clients' SELECT."""
    given = "SELECT DISTINCT given_name AS word FROM people WHERE given_name IS NOT NULL"
    family = "SELECT DISTINCT family_name AS word FROM people WHERE family_name IS NOT NULL"
    day = "(DOB - DATE '1970-01-01')"
    parts = ctes + [f"people AS ({registry})", *codes_ctes(given, "given"), *codes_ctes(family, "family"), f"""member AS (
        SELECT DISTINCT p.client_id, concat_ws(' ', given_name, family_name) AS full_name, Gender AS gender, g.code AS given_code,
               f.code AS family_code, w.place AS place
        FROM people p
        JOIN (SELECT word, unnest([code_primary, code_secondary]) AS code FROM given) g ON g.word = given_name
        JOIN (SELECT word, unnest([code_primary, code_secondary]) AS code FROM family) f ON f.word = family_name
        CROSS JOIN LATERAL (SELECT unnest([CAST(floor({day} / {days}.0) * 2 AS BIGINT),
                                           CAST(floor(({day} + {days // 2}) / {days}.0) * 2 + 1 AS BIGINT)]) AS place) w
        WHERE g.code <> '' AND f.code <> '' AND DOB IS NOT NULL)""",
        "firsts AS (SELECT given_code, family_code, gender, place, min(client_id) AS first_client_id, "
        "arg_min(full_name, client_id) AS first_name FROM member GROUP BY ALL)"]
    return ("WITH RECURSIVE " + ", ".join(parts) + " SELECT DISTINCT client_id, first_client_id, "
            "CAST(levenshtein(full_name, first_name) AS INTEGER) AS distance, "
            "round(jaro_winkler_similarity(full_name, first_name), 6) AS similarity FROM member m JOIN firsts b ON m.given_code = b.given_code "
            "AND m.family_code = b.family_code AND m.place = b.place AND m.gender IS NOT DISTINCT FROM b.gender "
            "WHERE client_id <> first_client_id")
