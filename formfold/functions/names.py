"""Phonetic codes of names (Double Metaphone) and the likeness of names, as Spark expressions.

All spellings are one regular expression.  It walks over a name from the left; at each place the
first spelling that fits is taken, its letters are replaced by what is heard, and the walk goes
on behind them.  What is heard is captured from a list that is written behind the name, since a
replacement can only repeat what was captured; marks before that list say what holds for
the name as a whole.  So a name costs one pass in generated code, whatever its length.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------------
# Double Metaphone as published by Lawrence Philips ("The Double Metaphone Search
# Algorithm", C/C++ Users Journal, June 2000), as a table of spellings.  A line is
#
#     before(letters)after   primary/secondary   [what holds for the name]
#
# `^` and `$` are the start and end of the name, `_` a blank or the end, `~` a vowel (Y is
# one), `[..]` one of some letters, `[^..]` another letter, `.` any letter, `%` any letters.
# `!X` at the end of a side says that X does not stand there (before: not up to the letters).
# One sound stands for both codes; `-` is silence; 0 is the English TH, X is SH.
# Of the spellings of a first letter, the first that fits holds.
#
# Three things differ from the published form, as the specification asks: accents are dropped,
# so that C with a cedilla is a C; B is heard as P; W before H at the start is heard as A.
SPELLINGS = """
Vowels are heard at the start only
    ^([AEIOUY])         A
    ([AEIOUY])          -

Letters that are mostly heard one way
    (BB)                P
    (B)                 P
    (FF)                F
    (F)                 F
    (KK)                K
    (MM)                M
    (NN)                N
    (N)                 N
    (PB)                P
    (PP)                P
    (QQ)                K
    (Q)                 K
    (RR)                R
    (VV)                F
    (V)                 F

Silent at the start: GNOME, KNIGHT, PNEUMONIA, PSALM, WRIGHT
    ^(G)N               -
    ^(K)N               -
    ^(P)N               -
    ^(P)S               -
    ^(W)R               -
    (K)                 K
    (PH)                F
    (P)                 P

C: words with a sound of their own
    BA(CH)ER            K
    MA(CH)ER            K
    ^(CA)ESAR           S
    OR(CH)ES            K
    OR(CH)ID            K
    AR(CH)IT            K
C: Greek and Italian CH is hard
    (CH)IA              K
    ^(CH)ARAC           K
    ^(CH)ARIS           K
    ^(CH)OR!E           K
    ^(CH)YM             K
    ^(CH)EM             K
C: Germanic CH is hard
    [^AEIOUY]A(CH)!E!I  K
    !^(CH)AE            K/X
    (CH)                K       germanic
    (CH)[TS]            K
    ^(CH)[BFHLMNRVW]    K
    ^(CH)_              K
    [AEOU](CH)[BFHLMNRVW] K
    [AEOU](CH)_         K
C: other CH
    ^(CH)               X
    (CH)                K       mc
    (CH)                X/K
C: Slavic CZ, not in WICZ
    !WI(CZ)             S/X
C: Italian and Latin CC
    (CCI)A              X
    U(CCE)[ES]          KS
    !^M(CC[EI])         X
    !^M(CCH)!U          X
    !^M(CC)             K
C: hard and soft
    (C[GKQ])            K
    (CI)[AEO]           S/X
    (C[EIY])            S
    (C [CGQ])           K
    (CC)!E!I            K
    (C)                 K

D
    (DG[EIY])           J
    (DG)                TK
    (D[DT])             T
    (D)                 T

G: GH is hard at the start and after consonants, silent or F after vowels
    ^(GH)I              J
    ^(GH)               K
    [^AEIOUY](GH)       K
    [BDH].(GH)          -
    [BDH]..(GH)         -
    [BH]...(GH)         -
    [CGLRT].U(GH)       F
    !I(GH)              K
    (G)H                -
G: French and Italian GN and GL
    ^~(GN)              KN/N    not slavic
    (GN)!EY             N/KN    not slavic
    (GN)                KN
    (GL)I               KL/L    not slavic
G: hard or soft at the start
    ^(GY)               K/J
    ^(GE)[BILPRSY]      K/J
    ^(GI)[BELN]         K/J
G: hard or soft before ER and Y, soft in DANGER, RANGER, MANGER
    !E!I(GE)R           K/J     not danger
    !E!I!O!R(GY)        K/J     not danger
G: Germanic G is hard
    (G[EIY])            K       germanic
    [AO](GG)I           K       germanic
    (GE)T               K
G: other soft G
    (GI)ER_             J
    (G[EIY])            J/K
    [AO](GG)I           J/K
    (GG)                K
    (G)                 K

H is heard between vowels and before the first
    ^(H~)               H
    ~(H~)               H
    (H)                 -

J: Spanish J is an H
    (JJ)                H       san
    (J)                 H       san
    ^(J)OSE_            H
    (J)OSE              J/H
J: at the start also a vowel
    ^(JJ)               J/A
    ^(J)                J/A
J: other
    ~(J)[AO]            J/H     not slavic
    (J)$                J/-
    !K!L!S(JJ)          J
    !K!L!S(J)!B!K!L!M!N!S!T!Z J
    (JJ)                -
    (J)                 -

L: Spanish endings in ILLO, ILLA, ALLE
    I(LL)[AO]$          L/-
    A(LL)E$             L/-
    A(LL)E%[AO]$        L/-
    A(LL)E%[AO]S$       L/-
    (LL)                L
    (L)                 L

M: B is silent in DUMB and THUMBER
    U(MB)$              M
    U(MB)ER             M
    (M)                 M

R: French ending IER, not after ME and MA
    IE!MEIE!MAIE(R)$    -/R     not slavic
    (R)                 R

S: silent in ISLAND and CARLYSLE
    [IY](S)L            -
S: words with a sound of their own
    ^(S)UGAR            X/S
    (SH)EIM             S
    (SH)OEK             S
    (SH)OLM             S
    (SH)OLZ             S
    (SH)                X
S: Italian and Armenian SIO and SIA
    (SI[AO])            S/X     not slavic
    (SI[AO])            S
S: German and Anglicised SCHMIDT as SMITH, SNYDER as SCHNEIDER; Slavic SZ
    ^(S)[LMNW]          S/X
    (SZ)                S/X
S: Dutch and German SCH
    (SCH)E[RN]          X/SK
    (SCH)E[DM]          SK
    (SCH)OO             SK
    (SCH)UY             SK
    ^(SCH)!A!E!I!O!U!Y!W X/S
    (SCH)               X
    (SC[EIY])           S
    (SC.)               SK
    (SC)                SK
S: French endings in AIS and OIS
    [AO]I(S)$           -/S
    (SS)                S
    (S)                 S

T
    (TIO)N              X
    (TIA)               X
    (TCH)               X
    (TH)[AO]M           T
    (TH)                T       germanic
    (TT)H               T       germanic
    (TH)                0/T
    (TT)H               0/T
    (T[DT])             T
    (T)                 T

W
    (WR)                R
    ^(W)~               A/F
    ^(W)H               A
    ~(W)$               -/F
    [EO](W)SK[IY]       -/F
    (W)                 -/F     sch
    (WI[CT]Z)           TS/FX
    (W)                 -

X: French endings in AUX and OUX
    ^(X)                S
    [AO]U(X)$           -
    (X[CX])             KS
    (X)                 KS

Z: Chinese ZH; Italian endings in ZZO, ZZI, ZZA; Slavic Z
    (ZHZ)               J
    (ZH)                J
    (ZZ)[AIO]_          S/TS
    !^!T(ZZ)            S/TS    slavic
    !^!T(Z)             S/TS    slavic
    (ZZ)                S
    (Z)                 S
"""
# What holds for a name as a whole, as a pattern of its letters.
WHOLE = {
    "slavic": "W|K|CZ",
    "germanic": "^(VAN|VON)( |$)|^SCH",
    "mc": "^MC",
    "san": "^SAN( |$)",
    "sch": "^SCH",
    "danger": "^(DANGER|MANGER|RANGER)",
}
# ---- end of fixed values ----------------------------------------------------------

END = "\n"  # parts a name from what is written behind it


@dataclass(frozen=True)
class Spelling:
    before: str
    letters: str
    after: str
    primary: str
    secondary: str
    holds: tuple[tuple[str, bool], ...]

    @property
    def sounds(self) -> tuple[tuple[str, str], ...]:
        """What is heard as pairs of a primary and a secondary letter; one may be empty."""
        n = max(len(self.primary), len(self.secondary))
        return tuple((p.strip(), s.strip()) for p, s in zip(self.primary.rjust(n), self.secondary.rjust(n)))


@lru_cache(maxsize=1)
def spellings() -> tuple[Spelling, ...]:
    out = []
    for text in SPELLINGS.splitlines():
        if found := re.fullmatch(r"    (\S*)\((.+?)\)(\S*) +(\S+) *(.*)", text):
            before, letters, after, sound, holds = found.groups()
            primary, _, secondary = sound.partition("/")
            heard = [x.replace("-", "") for x in (primary, secondary or primary)]
            marks = tuple((x.removeprefix("not "), not x.startswith("not ")) for x in holds.split(", ") if x)
            out.append(Spelling(before, letters, after, *heard, marks))
    return tuple(out)


def letters_of(text: str) -> str:
    """The regular expression of one side of a spelling."""
    for sign, meant in ((".", f"[^{END}]"), ("[^", f"[^{END}"), ("~", "[AEIOUY]"), ("%", f"[^{END}]*"),
                        ("$", f"(?={END})"), ("_", f"(?=[ {END}])")):
        text = text.replace(sign, meant)
    return text.replace(f"[^{END}{END}]", f"[^{END}]")


@lru_cache(maxsize=1)
def walk() -> tuple[str, int, str, tuple[tuple[str, str], ...]]:
    """The regular expression, how many sounds it captures, the list of sounds that is written
    behind a name, and the pairs of letters that the list is made of."""
    pairs = {p: chr(0xE000 + i) for i, p in enumerate(dict.fromkeys(p for s in spellings() for p in s.sounds))}
    listed, place = "", {}
    for s in spellings():
        text = "".join(pairs[p] for p in s.sounds)
        if text not in place:
            place[text] = len(WHOLE) + len(listed)
            listed += text
    captured, by_first = 0, {}
    for s in spellings():
        first = re.match(r"\[.*?\]|.", s.letters).group()
        read, rest = letters_of(s.letters), letters_of(s.letters[len(first):])
        (before, *not_before), (after, *not_after) = s.before.split("!"), s.after.split("!")
        tests = [f"(?<={letters_of(before)}{read})"] if before else []
        tests += [f"(?<!{letters_of(x)}{read})" for x in not_before]
        if after or not_after:
            tests.append(f"(?={letters_of(after)}{''.join(f'(?!{letters_of(x)})' for x in not_after)})")
        behind = f"(?=[^{END}]*+{END}"
        tests += [f"{behind}.{{{list(WHOLE).index(name)}}}{int(wanted)})" for name, wanted in s.holds]
        heard = "".join(pairs[p] for p in s.sounds)
        if heard:
            tests.append(f"{behind}.{{{place[heard]}}}(.{{{len(heard)}}}))")
            captured += 1
        by_first.setdefault(first, []).append(rest + "".join(tests))
    letters = "|".join(f"{first}(?:{'|'.join(texts)})" for first, texts in by_first.items())
    return f"{letters}|{END}(?s:.*)|[^{END}]", captured, listed, tuple(pairs)


@lru_cache(maxsize=1)
def plain_letters() -> tuple[str, str, str]:
    """Letters with marks, the same without, and the marks that stand alone."""
    marked = [chr(c) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]]
    bare = {c: unicodedata.normalize("NFD", c)[0] for c in marked}
    bare = {c: b.upper() for c, b in bare.items() if b.isascii() and b != c}
    bare["ß"] = "S"
    return "".join(bare), "".join(bare.values()), "".join(map(chr, range(0x300, 0x370)))


def plain(name: Column) -> Column:
    """The upper case of a name without accents; empty for a missing one."""
    marked, bare, marks = plain_letters()
    return F.upper(F.translate(F.coalesce(name, F.lit("")), f"{END}{marked}{marks}", f"\u0001{bare}"))


def heard(name: Column) -> Column:
    """What is heard of a name, a letter for each pair of sounds."""
    expression, captured, listed, _ = walk()
    word = plain(name)
    marks = [F.when(word.rlike(pattern), "1").otherwise("0") for pattern in WHOLE.values()]
    behind = F.concat(word, F.lit(END), *marks, F.lit(listed))
    return F.regexp_replace(behind, expression, "".join(f"${i}" for i in range(1, captured + 1)))


def spoken(sounds: Column, side: int) -> Column:
    """The primary (0) or secondary (1) code of what is heard."""
    pairs = sorted(((p[side], chr(0xE000 + i)) for i, p in enumerate(walk()[3])), key=lambda x: not x[0])
    # translate drops the letters at the end that have no counterpart: the silent ones
    return F.translate(sounds, "".join(c for _, c in pairs), "".join(p for p, _ in pairs))


def codes(name: str) -> Column:
    """Struct of code_primary and code_secondary of a column; empty for a missing name."""
    sounds = heard(F.col(name))
    return F.struct(spoken(sounds, 0).alias("code_primary"), spoken(sounds, 1).alias("code_secondary"))


def name_codes(df: DataFrame, column: str) -> DataFrame:
    """Add ``code_primary``, ``code_secondary`` and ``code`` (both, ``;`` between,
    when they differ).  A narrow step: no shuffle, so no hot name."""
    coded = df.withColumn("_heard", heard(F.col(f"`{column}`")))
    coded = coded.withColumns({"code_primary": spoken(F.col("_heard"), 0), "code_secondary": spoken(F.col("_heard"), 1)})
    both = F.concat_ws(";", "code_primary", "code_secondary")
    same = F.col("code_primary") == F.col("code_secondary")
    return coded.withColumn("code", F.when(same, F.col("code_primary")).otherwise(both)).drop("_heard")
