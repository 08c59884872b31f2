"""Job settings: folders, sender rules, taxonomy. All of it is input; what is not given is empty."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from pathlib import Path

from .functions.scalars import INITIATIVES
from .operators.classify import Taxonomy

try:  # YAML is optional; JSON always works
    import yaml
except ImportError:
    yaml = None

def read_config(path: str) -> dict:
    text = Path(path).read_text(encoding="utf-8")
    if path.lower().endswith(".json"):
        return json.loads(text)
    if yaml is None:
        raise ImportError("PyYAML is not installed: use a .json file")
    return yaml.safe_load(text)


@dataclass(frozen=True)
class Settings:
    """``folders``: folder names of each export family; files in other folders are not handled."""

    salt: str
    folders: dict[str, list[str]] = field(default_factory=dict)
    month_pattern: str = r"^\d{4}-\d{2}$"
    internal_domains: list[str] = field(default_factory=list)
    automated_patterns: list[str] = field(default_factory=list)
    typed_domains: dict[str, list[str]] = field(default_factory=dict)
    exclude_staff: bool = True
    volume_alert_ratio: float = 0.5
    stop_words: list[str] = field(default_factory=list)  # further words that are no names
    allowed_domains: list[str] = field(default_factory=list)  # system addresses the leak check lets pass
    initiatives: list[tuple[str, str]] = field(default_factory=lambda: list(INITIATIVES))

    def __post_init__(self) -> None:
        if len(self.salt) < 16:
            raise ValueError("the salt must have 16 characters or more")

    @classmethod
    def from_config(cls, config: dict, salt: str, **more) -> Settings:
        """Settings from a configuration with the sections sources, freshdesk and sprig."""
        mail = config.get("freshdesk", {})
        known = {
            "folders": config.get("sources"),
            "month_pattern": config.get("month_pattern"),
            "internal_domains": mail.get("exclude_internal_domains"),
            "automated_patterns": mail.get("exclude_automated_patterns"),
            "typed_domains": mail.get("sender_types"),
            "exclude_staff": config.get("sprig", {}).get("exclude_staff"),
            "volume_alert_ratio": config.get("volume_alert_ratio"),
        }
        return cls(salt=salt, **{k: v for k, v in known.items() if v is not None}, **more)


def load_taxonomy(path: str) -> Taxonomy:
    """Taxonomy file: version, ordered areas with id, label and keywords, exact maps."""
    config = read_config(path)
    digest = hashlib.sha256(Path(path).read_text(encoding="utf-8").encode()).hexdigest()
    version = config.get("version")
    return Taxonomy(
        areas=[(a["id"], [str(k) for k in a.get("keywords", [])]) for a in config["areas"]],
        source_map={
            name: {key: (entry["area"], entry.get("theme")) for key, entry in keys.items()}
            for name, keys in config.get("source_map", {}).items()
        },
        version=None if version is None else str(version),
        content_hash=digest[:10],
        labels={a["id"]: a.get("label", a["id"]) for a in config["areas"]},
    )
