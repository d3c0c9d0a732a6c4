"""Filter settings of one language, as parameters."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, replace
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class Profile:
    """Thresholds and word lists; the defaults are those for Greek in Greek script."""

    language: str = "ell"
    # Thresholds of the language's filter settings.
    language_score: float = 0.826
    keep_pairs: float = 0.01
    dup_line_frac: float = 0.31
    dup_para_frac: float = 0.0
    dup_line_char_frac: float = 0.0
    dup_para_char_frac: float = 0.0
    top_n_grams: tuple[tuple[int, float], ...] = ((2, 0.194), (3, 0.175), (4, 0.156))
    dup_n_grams: tuple[tuple[int, float], ...] = ((5, 0.174), (6, 0.163), (7, 0.153), (8, 0.142), (9, 0.13), (10, 0.119))
    line_punct: float = 0.167
    char_dup: float = 0.1
    new_line_ratio: float = 0.116
    short_line_length: int = 30
    short_line_frac: float = 999.0
    min_words: int = 50
    max_words: int = 100_000
    min_avg_word_length: float = 3
    max_avg_word_length: float = 11
    max_symbol_ratio: float = 0.1
    max_bullet_frac: float = 0.9
    max_ellipsis_frac: float = 0.3
    min_alpha_ratio: float = 0.809
    min_stop_words: int = 2
    stop_words: tuple[str, ...] = ("του", "και", "το", "της", "η", "την", "από", "ο", "με", "τον", "να", "που", "των", "στην", "για", "στο", "σε", "είναι", "τη", "τα", "οι")
    mimes: tuple[str, ...] = ("text/html", "application/xhtml+xml")
    # Frequent function words of the languages the default scorer tells apart.
    profiles: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "ell": ("του", "και", "το", "της", "η", "την", "από", "ο", "με", "τον", "να", "που", "των", "στην", "για", "στο", "σε", "είναι", "τη", "τα", "οι", "τους", "τις", "στους", "στις", "στα", "στον"),
            "eng": ("the", "and", "of", "to", "in", "which", "when", "but", "them", "that", "with", "for", "often", "there", "were", "is", "are", "not", "under", "before"),
            "deu": ("die", "der", "das", "und", "für", "wenn", "wir", "nicht", "es", "gibt", "sind", "ist", "den", "sie", "im", "am", "ohne", "nach", "vor", "von"),
            "fra": ("les", "des", "la", "le", "et", "quand", "nous", "il", "qui", "mais", "de", "une", "dans", "sur", "sans", "avant", "avec", "est", "un", "pour"),
            "bul": ("и", "са", "не", "без", "на", "в", "през", "че", "които", "ние", "когато", "всички", "има", "край", "след", "с", "от", "като", "преди", "за"),
            "tur": ("için", "bütün", "ile", "vardı", "ama", "şimdi", "çok", "bugün", "arasında", "boyunca", "önce", "sonra", "gibi", "ve", "bir", "bu", "olmadan", "yanında", "kış", "daha"),
        }
    )
    # Block lists of the address filter: the user's tables.
    blocked_domains: tuple[str, ...] = ()
    blocked_hosts: tuple[str, ...] = ()
    blocked_urls: tuple[str, ...] = ()
    hard_words: tuple[str, ...] = ()
    soft_words: tuple[str, ...] = ()
    soft_limit: int = 2
    banned_parts: tuple[str, ...] = ()


GREEK = Profile()

#: Names of settings in the reference's files where they differ from the fields here.
SETTINGS = {"line_punct_thr": "line_punct", "max_non_alpha_words_ratio": "min_alpha_ratio", "stopwords": "stop_words"}


def _plain(value: Any) -> Any:
    return tuple(map(_plain, value)) if isinstance(value, list) else value


def load(path: str, base: Profile = GREEK) -> Profile:
    """A profile from a settings file (YAML or JSON): its values in place of those of `base`; an unknown name is an error."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        found = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("reading YAML settings needs the yaml package; JSON settings do without") from e
        found = yaml.safe_load(text)
    named = {SETTINGS.get(k, k): _plain(v) for k, v in (found or {}).items()}
    unknown = set(named) - {f.name for f in fields(Profile)}
    if unknown:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    return replace(base, **named)
