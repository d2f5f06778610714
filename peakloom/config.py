"""Settings of an analysis. Cut-offs for cells have no default and must be given."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class QcCutoffs:
    """A cell passes with at least tsse and fragments, and at most doublet."""

    tsse: float
    fragments: int
    doublet: float


@dataclass(frozen=True)
class Config:
    # Fixed values that results depend on.
    shift_left: int = 4
    shift_right: int = -5
    fragment_shorter: int = 1000
    fragment_longer: int = 30
    base_quality: int = 15
    tss_half: int = 2000
    tss_flank: int = 100
    tss_pseudo: float = 0.1
    tss_taps: int = 5
    promoter_half: int = 1000
    gene_body_upstream: int = 2000
    wide_promoter: tuple[int, int] = (5000, 1000)
    index_reads: int = 100_000_000
    scatter_fragments: int = 100
    feature_z: float = 1.65
    neighbours: int = 50
    landmarks: int = 35_000
    subcluster_seed: int = 23948
    subcluster_cells: int = 100
    reproducibility: float = 0.5
    genome_share: float = 0.9
    peak_half: int = 200
    accessibility_scale: float = 2.5
    motif_p: float = 1e-5
    open_half: int = 50
    background_peaks: int = 50
    doublet_p: float = 0.5
    peak_shift: int = -100
    peak_extend: int = 200
    peak_q: float = 0.05


DEFAULT = Config()
MITOCHONDRIAL = ("chrM", "M")
