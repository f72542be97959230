"""Pipeline settings; read from YAML, unknown keys ignored, an empty file gives the defaults."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass


@dataclass
class Ocr:
    enabled: bool = True
    force_full_page: bool = False
    languages: list[str] = field(default_factory=lambda: ["en"])


@dataclass
class Tables:
    mode: str = "accurate"
    do_cell_matching: bool = True

    def __post_init__(self):
        if self.mode not in ("fast", "accurate"):
            raise ValueError(f"tables.mode must be fast or accurate, not {self.mode!r}")


@dataclass
class Thresholds:
    """expected_pages: null by default, as a corpus has no one page count."""

    expected_pages: int | None = None
    minimum_text_characters: int = 100
    maximum_heading_level_jump: int = 1
    minimum_table_fill_ratio: float = 0.5


@dataclass
class Captions:
    enabled: bool = False
    max_output_tokens: int = 220
    skip_kinds: list[str] = field(default_factory=lambda: ["logo/icon"])


@dataclass
class Config:
    ocr: Ocr = field(default_factory=Ocr)
    tables: Tables = field(default_factory=Tables)
    qa: Thresholds = field(default_factory=Thresholds)
    captions: Captions = field(default_factory=Captions)
    image_scale: float = 2.0
    generate_page_images: bool = True
    generate_picture_images: bool = True
    repeated_text_min_pages: int = 3

    @classmethod
    def from_yaml(cls, path: str) -> Config:
        import yaml

        with open(path, encoding="utf-8") as f:
            return _fill(cls, yaml.safe_load(f) or {})


def _fill(kind, values: dict):
    made = {}
    for f in fields(kind):
        if f.name in values:
            default = f.default_factory() if callable(f.default_factory) else f.default
            made[f.name] = _fill(type(default), values[f.name] or {}) if is_dataclass(default) else values[f.name]
    return kind(**made)
