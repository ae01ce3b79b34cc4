"""Settings, as plain dataclasses that also load from JSON."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field

from linernotes import fixed_values as fv


@dataclass(frozen=True)
class CurationConfig:
    first_year: int = fv.FIRST_YEAR
    last_year: int = fv.LAST_YEAR
    styles: dict[str, bool] = field(default_factory=lambda: dict(fv.STYLES))
    labels: dict[str, tuple[str, bool]] = field(default_factory=lambda: dict(fv.LABELS))
    performing_roles: list[str] = field(default_factory=lambda: list(fv.PERFORMING_ROLES))
    excluded_roles: list[str] = field(default_factory=lambda: list(fv.EXCLUDED_ROLES))
    # Prefix of the documents' URLs; a missing URL is rebuilt as <base>/masters/<id> and so on.
    url_base: str = ""

    @property
    def enabled_styles(self) -> list[str]:
        return [style for style, on in self.styles.items() if on]

    @property
    def enabled_labels(self) -> dict[str, str]:
        return {key: name for key, (name, on) in self.labels.items() if on}


@dataclass(frozen=True)
class BronzeConfig:
    """Where landed JSON lies, where the bronze table goes and how each is read or written."""

    landing: str
    bronze: str
    # Beside the table, never inside it: the first write clears the table's own folder.
    checkpoint: str
    database: str = "bronze"
    subdir: str = "albums"
    source_format: str = "json"
    schema: str | None = fv.ALBUM_DDL
    reader_options: dict[str, str] = field(default_factory=dict)
    max_files_per_trigger: int = fv.MAX_FILES_PER_TRIGGER
    # Landed files older than the newest one seen by more than this are never read.
    max_file_age: str = fv.MAX_FILE_AGE
    # Where landed files are moved to when their batch is committed; None leaves them in the landing folder.
    # Not below the landing folder.
    archive: str | None = None
    # Folder of files stored before, at any depth: landed files of the same names are not read. May be the archive.
    stored: str | None = None
    format: str = "parquet"
    # With "overwrite" each micro-batch replaces all before it: only the last one's rows stay.
    mode: str = "append"
    partition_by: tuple[str, ...] = ()
    writer_options: dict[str, str] = field(default_factory=dict)
    # None lets Spark choose files of its advisory size; a number puts every batch into so many tasks. 0 lets the
    # tasks that read landed files write them, without a shuffle: for landed files of good size.
    files_per_batch: int | None = None
    # Whether a refresh goes on when a landed file holds no readable record at all.
    allow_unreadable_files: bool = False

    @property
    def path(self) -> str:
        return f"{self.bronze.rstrip('/')}/{self.subdir}"

    @property
    def table(self) -> str:
        return f"{self.database}.{self.subdir}"

    @property
    def quarantine(self) -> str:
        """Folder of the rows that could not be used."""
        return f"{self.bronze.rstrip('/')}/{self.subdir}_quarantine"


@dataclass(frozen=True)
class GoldConfig:
    path: str
    database: str = "gold"
    format: str = "parquet"
    writer_options: dict[str, str] = field(default_factory=dict)


def load(cls, path: str):
    """Read one of the classes above from a JSON file; unknown keys are an error."""
    with open(path, encoding="utf-8") as f:
        values = json.load(f)
    unknown = set(values) - {f.name for f in dataclasses.fields(cls)}
    if unknown:
        raise ValueError(f"unknown settings for {cls.__name__}: {sorted(unknown)}")
    return cls(**values)
