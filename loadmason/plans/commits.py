"""The commit log beside a table: which load changed what, in which order.

Entry ``n`` is a small file that only one load can make: whoever finds its
number taken has to look again at what the table holds. It lists the files to
add and to remove, or the folder that becomes the table, and is carried out
afterwards. Carrying out may be repeated, so an entry whose load was cut short
is completed by the next load, and a load that made no entry never happened.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from ..errors import CommitConflict
from ..session import create_whole, list_names, read_text

ATTEMPTS = 8
_WIDTH = 20


@dataclass
class Entry:
    """One change of a table. ``location`` is the table's folder after it."""

    location: str
    kind: str
    loading: str | None = None  # the folder that holds files to add; gone once they are added
    add: list[str] = field(default_factory=list)  # below ``loading``
    remove: list[str] = field(default_factory=list)  # whole paths
    batches: dict[str, int] = field(default_factory=dict)  # the last batch of each stream
    ledgers: list[str] = field(default_factory=list)  # folders that list the files loaded so far
    versions: list[dict] = field(default_factory=list)  # folders the table had before, the newest first
    stale: list[dict] = field(default_factory=list)  # such folders that go
    emptied: list[list[str]] = field(default_factory=list)  # partitions that lost their last file, and their folders


class CommitLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def latest(self) -> tuple[int, Entry | None]:
        """The number of the last entry and the entry; 0 and None before the first."""
        names = [n for n in list_names(self.spark, self.folder) if n.endswith(".json") and n[:_WIDTH].isdigit()]
        if not names:
            return 0, None
        last = max(names)
        return int(last[:_WIDTH]), Entry(**json.loads(read_text(self.spark, f"{self.folder}/{last}")))

    def add(self, number: int, entry: Entry) -> None:
        """Makes the entry of that number, unless another load has."""
        text = json.dumps(asdict(entry))
        path = f"{self.folder}/{number:0{_WIDTH}d}.json"
        if not create_whole(self.spark, path, text, f"{self.folder}/_{uuid.uuid4().hex}"):
            raise CommitConflict(f"another load has made entry {number} of {self.folder}")


def retried(attempt: Callable[[], object], attempts: int = ATTEMPTS) -> object:
    """Runs it again while other loads come first."""
    for left in range(attempts - 1, -1, -1):
        try:
            return attempt()
        except CommitConflict:
            if not left:
                raise
