"""Code tables and defaults that results depend on."""

from __future__ import annotations

BASES = {"A": 0, "C": 1, "G": 2, "T": 3}
UNKNOWN, DELETION, INSERTION_COLUMN, BATCH_PAD = 4, 5, 6, 7
LETTERS = "ACGTN- #"
CELL_GAP, CELL_MATCH, CELL_MISMATCH, CELL_DELETION, CELL_INSERTION, CELL_PAD = 0, 1, 2, 3, 4, 5
PLATFORMS = {"ILLUMINA": 0, "PACBIO": 1, "NANOPORE": 2}
UNMAPPED, REVERSE, FIRST, LAST, SECONDARY, DUPLICATE, SUPPLEMENTARY = 0x4, 0x10, 0x40, 0x80, 0x100, 0x400, 0x800
NOT_PRIMARY = SECONDARY | SUPPLEMENTARY
DROPPED_TAGS = ("MD", "MC", "XS", "NM")
#: platform -> loose clip ratio, loose aligned length, strict clip ratio, strict clip length, trusted margin
READ_LIMITS = {
    "NANOPORE": (0.50, 2000, 0.10, 400, 50),
    "HIFI": (0.40, 1000, 0.05, 200, 50),
    "ILLUMINA": (0.20, 50, 0.05, 10, 5),
}
