"""Where the tables of a dataset live."""

from __future__ import annotations

from dataclasses import dataclass

from tidemark.schemas import PARTITION_COLUMNS


@dataclass(frozen=True)
class DatasetLayout:
    """``partition_columns`` name the folders of versions and of the projection, outermost first.

    Any of the series code, year and month: fewer of them make fewer and larger files.  A
    dataset keeps those it was first projected with.  With ``track_files`` every merge notes what
    its files hold, so that later ones read only files that overlap them.
    """

    root: str
    dataset_id: str
    partition_columns: tuple[str, ...] = tuple(PARTITION_COLUMNS)
    track_files: bool = False

    def __post_init__(self) -> None:
        named = self.partition_columns
        if not named or len(set(named)) != len(named) or not set(named) <= set(PARTITION_COLUMNS):
            raise ValueError(f"partition columns are some of {PARTITION_COLUMNS}: {named}")

    @property
    def partition_strategy(self) -> str:
        return "_".join(self.partition_columns).replace("internal_series_code", "series")

    @property
    def base(self) -> str:
        return f"{self.root.rstrip('/')}/datasets/{self.dataset_id}"

    @property
    def versions(self) -> str:
        return f"{self.base}/versions"

    def version(self, version_id: str) -> str:
        return f"{self.versions}/{version_id}"

    def data(self, version_id: str) -> str:
        return f"{self.version(version_id)}/data"

    def file_index(self, version_id: str) -> str:
        return f"{self.version(version_id)}/file_index"

    def manifest(self, version_id: str) -> str:
        return f"{self.version(version_id)}/manifest.json"

    def staging(self, version_id: str, attempt: str) -> str:
        return f"{self.base}/staging/{version_id}-{attempt}"

    @property
    def projections(self) -> str:
        return f"{self.base}/projections"

    @property
    def commit_log(self) -> str:
        return f"{self.base}/commit_log"

    @property
    def projected_versions(self) -> str:
        return f"{self.base}/projected_versions"

    @property
    def publish_log(self) -> str:
        return f"{self.base}/publish_log"

    @property
    def state_log(self) -> str:
        return f"{self.base}/state_log"

    @property
    def run_journal(self) -> str:
        return f"{self.base}/run_journal"

    def marks(self, version_id: str) -> str:
        return f"{self.version(version_id)}/marks"

    def late_rows(self, version_id: str = "") -> str:
        """The late rows of a batch, or the folder with those of all."""
        return f"{self.base}/late_rows" + (f"/batch={version_id}" if version_id else "")

    def frozen_marks(self, catch_up: str) -> str:
        return f"{self.base}/frozen_marks/{catch_up}"

    def refused(self, version_id: str = "") -> str:
        """What the merge of a version refused, or the folder with that of all."""
        return f"{self.base}/refused" + (f"/version_id={version_id}" if version_id else "")

    def file_records(self, version_id: str = "") -> str:
        """What the merge of a version did to the projection's files, or the folder with all."""
        return f"{self.base}/file_records" + (f"/version_id={version_id}" if version_id else "")

    @property
    def update_events(self) -> str:
        return f"{self.base}/update_events"
