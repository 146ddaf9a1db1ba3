"""Motifs of poly(A) signals as string functions; no UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

NOT_FOUND = "not_found"

#: Published poly(A) signal hexamers, most frequent first.
GRUBER_MOTIFS = ("AATAAA", "ATTAAA", "TATAAA", "AGTAAA", "AATACA", "CATAAA", "AATATA", "GATAAA", "AATGAA", "AATAAT", "AAGAAA", "ACTAAA", "AATAGA", "ATTACA", "AACAAA", "ATTATA", "AACAAG", "AATAAG")
BEAUDOING_MOTIFS = ("AATAAA", "ATTAAA", "TATAAA", "AGTAAA", "AAGAAA", "AATATA", "AATACA", "CATAAA", "GATAAA", "AATGAA", "ACTAAA", "AATAGA")
MOTIF_SETS = {"Gruber": GRUBER_MOTIFS, "Beaudoing": BEAUDOING_MOTIFS}


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


#: Letters that mark hits in a text, and what a text's own ones become; no motif has them.
_HIT, _END, _OTHER = "\ue000", "\ue001", "\ue002"
#: Hits that are appended to one list before a new one is begun.
_BLOCK = 64
_HITS = "array<struct<distance:int,motif:string>>"


def _one_of(words: Sequence[str]) -> str:
    """A pattern of words of one size, in which common beginnings are tried once."""
    if len(words[0]) <= 1:
        return words[0] and "[" + "".join(_quoted(w) for w in sorted(words)) + "]"
    heads = sorted({w[0] for w in words})
    return "(?:" + "|".join(_quoted(h) + _one_of([w[1:] for w in words if w[0] == h]) for h in heads) + ")"


def _quoted(letter: str) -> str:
    return letter if letter.isalnum() else "\\" + letter


def _hits_of(seq: Column, words: Sequence[str], region_length: int) -> Column:
    """Hits of words of one size.

    One pass of the pattern marks every place where a word stands, overlapping ones too, and names the
    word; the text is cut at the marks, and the sizes of the pieces, added up, are the places.  So a
    place without a hit costs no more than a step of the pattern, and lists stay short.
    """
    size = len(words[0])
    clean = F.translate(seq, _HIT + _END, _OTHER * 2)
    pieces = F.split(F.regexp_replace(clean, f"(?=({_one_of(words)}))", f"{_HIT}$1{_END}"), _HIT)
    kind = f"struct<at:int,hits:{_HITS}>"
    empty = F.array().cast(_HITS)

    def step(acc: Column, piece: Column) -> Column:
        hit = F.substring(piece, size + 1, 1) == _END
        own = F.struct((acc["at"] + size - region_length).cast("int").alias("distance"), F.substring(piece, 1, size).alias("motif"))
        at = acc["at"] + F.length(piece) - F.when(hit, size + 1).otherwise(0)
        return F.struct(at.alias("at"), F.when(hit, F.array_append(acc["hits"], own)).otherwise(acc["hits"]).alias("hits")).cast(kind)

    def blocks(own: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(own), F.lit(_BLOCK))
        zero = F.array(F.struct(F.lit(0).alias("at"), empty.alias("hits")).cast(kind)).cast(f"array<{kind}>")
        return F.aggregate(starts, zero, lambda acc, k: F.array_append(acc, F.aggregate(F.slice(own, k, _BLOCK), F.struct(F.element_at(acc, -1)["at"].alias("at"), empty.alias("hits")).cast(kind), step)).cast(f"array<{kind}>"))

    # the pieces are bound once: an expression that is named twice would be worked out twice
    found = F.flatten(F.transform(F.array(pieces), blocks))
    return F.when(seq.isNotNull(), F.flatten(F.transform(found, lambda b: b["hits"])))


def motif_hits(seq: Column, motifs: Sequence[str], region_length: int) -> Column:
    """Array of (distance, motif) for all occurrences, overlapping ones too, in order of place; null for a null text.

    The distance is that of the motif's last base from the last base of a region of the stated
    length, so 0 or less.
    """
    sizes = sorted({len(m) for m in motifs if m})
    each = [_hits_of(seq, sorted({m for m in motifs if len(m) == size}), region_length) for size in sizes]
    return each[0] if len(each) == 1 else F.array_sort(F.concat(F.array().cast(_HITS), *each))


def motif_string(hits: Column) -> Column:
    """Hits as distance_motif, joined by commas; not_found if there is none."""
    listed = lambda h: F.when(F.size(h) > 0, F.array_join(F.transform(h, lambda x: F.concat_ws("_", x["distance"], x["motif"])), ",")).otherwise(NOT_FOUND)
    return F.element_at(F.transform(F.array(hits), listed), 1)


def parse_motif_string(text: Column) -> Column:
    """Distances of a motif string, in order; empty if nothing was found."""
    parts = F.when(F.coalesce(text, F.lit(NOT_FOUND)) == NOT_FOUND, F.array().cast("array<string>")).otherwise(F.split(text, ","))
    return F.transform(parts, lambda p: F.split(p, "_")[0].cast("int"))


def least_deviation(distances: Column, expected: int) -> Column:
    """Struct of deviation and distance for the hit nearest to ``expected`` bases before the end; the first of equals."""
    ranked = F.transform(distances, lambda d, i: F.struct(F.abs(d + expected).alias("deviation"), i.alias("i"), d.alias("distance")))
    return F.array_min(ranked)
