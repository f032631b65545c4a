"""Settings, fixed tables and word lists.

All operators take a Config and, where words are needed, a Lexicon; neither reads the environment or a file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

#: Results depend on them.
EPS = 1e-6
NEUTRAL = 0.5
MAD_SCALE = 1.4826
TIERS = ((2.0, "Extremely"), (1.5, "Very"), (1.0, "Notably"), (0.5, "Somewhat"))
SHORT_TIERS = {"Extremely": "very", "Very": "very", "Notably": "", "Somewhat": "slightly"}
GENUINE = ((0.5, "deeply and genuinely felt"), (0.0, "genuine in delivery"), (-1.0, "only slightly genuine, somewhat performed"))
NOT_GENUINE = "measured and performed rather than genuine"
BLEND = ("interwoven with vocal bursts (laughs, gasps, sighs)", "clean of non-verbal vocal bursts")
BLEND_TAGS = ("with-bursts", "burst-free")
TEMPLATES = ("default", "identity_first", "emotion_first", "telegraphic", "two_sentence", "sounds_like", "bulleted", "varied_connectors", "quality_led", "minimal_identity", "tags")
BURST_PHRASES = ("punctuated by a ({b})", "with an audible ({b})", "broken by a ({b})", "carrying a ({b})", "interrupted by a ({b})", "marked by a ({b})")
TRANSIENT = ("mouth_and_lip_sounds", "tongue_clicks", "hand_and_body_sounds")
NOTHING = "An average, unremarkable voice."
#: Fixed values as well: upper bounds and phrases of the dimensions that are read as levels, and their tags.
BANDS = {
    "GEND": ((1.5, "clearly feminine and high-pitched"), (2.5, "feminine and high-pitched"), (3.5, "androgynous, gender-ambiguous in pitch"), (4.5, "masculine and deep-pitched"), (99.0, "strongly masculine, deep and low-pitched")),
    "AGEV": ((1.5, "childlike"), (2.5, "young and youthful"), (3.5, "adult"), (4.5, "middle-aged to mature"), (99.0, "elderly-sounding")),
    "REGS": ((1.5, "low and bassy in register"), (2.5, "low-to-mid in register"), (3.5, "mid register"), (4.5, "high in register"), (99.0, "very high in register")),
}
BAND_TAGS = {
    "GEND": ("feminine", "feminine", "androgynous", "masculine", "masculine"),
    "AGEV": ("child", "young", "adult", "middle-aged", "elderly"),
    "REGS": ("low-register", "low-register", "mid-register", "high-register", "high-register"),
}
NEUTRAL_PHRASES = {"TEMP": "moderate in tempo"}


@dataclass(frozen=True)
class Config:
    """Everything that can be turned; the defaults are those of the described data flow."""

    k_dims: int = 5
    k_emotions: int = 3
    always_on: tuple[str, ...] = ("AGEV", "GEND", "REGS", "TEMP")
    gated_dim: str = "GEND"
    confidence_gate: float = 0.5
    template: str = "default"
    locator_threshold: float = 0.75
    no_burst_gate: float = 0.5
    min_duration: float = 0.30
    min_transient: float = 0.60
    pause: float = 0.30
    frames_per_second: int = 50
    min_frames: int = 3
    slack: float = 0.2
    pad: float = 0.1
    sample_rate: int = 16_000
    strict_sentence: bool = False


@dataclass(frozen=True)
class Lexicon:
    """Words of dimensions.  dims: code -> (high phrase, low phrase, high tag, low tag); a dimension without an entry is not described."""

    dims: Mapping[str, Sequence[str | None]] = field(default_factory=dict)
    bands: Mapping[str, Sequence[tuple[float, str]]] = field(default_factory=lambda: BANDS)
    band_tags: Mapping[str, Sequence[str]] = field(default_factory=lambda: BAND_TAGS)
    neutral: Mapping[str, str] = field(default_factory=lambda: NEUTRAL_PHRASES)
