"""Parameters of the conversational flow. The defaults are the authoritative ones; presets hold the documented alternatives."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, replace
from hashlib import sha256

# Words that carry no content as replies.
FILLERS = (
    "uh", "um", "ah", "eh", "er", "hmm", "mhm", "mm-hmm", "uh-huh", "huh", "ooh", "oh", "yeah", "ya", "ok", "okay", "alright", "yep", "yup", "nah",
    "for sure", "exactly", "totally", "like", "so", "you know", "i mean", "right", "well", "actually", "basically", "literally", "i guess", "i think",
    "sort of", "kind of", "you see", "i know", "believe me", "i'm sure", "of course", "i see", "gotcha", "cool", "wow", "oh wow", "what", "really",
    "thank you", "thanks",
)
INTERROGATIVES = ("what", "who", "when", "where", "why", "how", "is", "are", "do", "does", "did", "can", "could", "will", "would", "should")


# The default weights and parameters.
@dataclass(frozen=True)
class Weights:
    avg_conf: float = 0.2
    overlap: float = 1.0
    ratio: float = 1.0
    similarity: float = 1.0
    punc: float = 0.2
    diversity: float = 0.1
    input_len: float = 0.1
    output_len: float = 0.1


@dataclass(frozen=True)
class PairConfig:
    merge_gap: float = 1.5
    max_context: int = 10
    min_words: int = 7
    min_conf: float | None = 0.5
    overlap_frac: float = 0.80
    min_quality: float = 0.60
    identify_threshold: float = 0.70
    reid_threshold: float = 0.60
    reid_override: float = 0.82
    reassign_window: float = 1.0
    short_reply_min_conf: float = 0.85
    prefilter_conf: float = 0.70
    min_emb_duration: float = 1.0
    max_input_words: int = 50
    flag_overlap: float = 0.80
    flag_low_conf: float = 0.30
    flag_ratio: float = 10.0
    single_ratio: float = 0.98
    conf_floor: float = 0.4
    conf_grace: float = 0.1
    conf_percentile: float = 0.3
    dominance_margin: float = 0.05
    short_word: int = 3
    vad_mult: float = 0.3
    frame_seconds: float = 0.03
    fillers: tuple[str, ...] = FILLERS
    interrogatives: tuple[str, ...] = INTERROGATIVES
    weights: Weights = field(default_factory=Weights)
    use_filtered_words: bool = False
    dominance: str = "strict"
    carry_meta: bool = False

    @classmethod
    def readme(cls) -> PairConfig:
        return cls(min_quality=0.55, min_words=5, merge_gap=3.0, reid_threshold=0.72, weights=Weights(ratio=0.5, diversity=0.5))

    @classmethod
    def tuned(cls) -> PairConfig:
        return cls(min_quality=0.57, reid_threshold=0.72, weights=Weights(ratio=0.5, diversity=0.5))

    @classmethod
    def profile(cls, name: str) -> PairConfig:
        return cls(vad_mult={"relaxed": 0.2, "balanced": 0.3, "conservative": 0.5}[name])

    def with_(self, **changes) -> PairConfig:
        return replace(self, **changes)

    def fingerprint(self) -> str:
        """Names stage tables, so that a changed parameter never meets an old table."""
        return sha256(repr(sorted(asdict(self).items())).encode()).hexdigest()[:16]
