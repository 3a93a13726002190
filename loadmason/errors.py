"""Errors raised on the driver, before or instead of a load."""


class SchemaMismatch(ValueError):
    """A source schema cannot go into a target schema."""


class TargetMissing(ValueError):
    """The target table is unnamed, absent or has no usable columns."""


class SignatureMismatch(ValueError):
    """Staged data was written for another schema."""


class LoadAborted(RuntimeError):
    """The fault limit was reached; the target was not touched."""

    def __init__(self, table, report):
        self.report = report
        super().__init__(
            f"load into {table} reached the maximum of allowable errors: "
            f"limit {report.max_errors}, faults {report.rejected}; "
            f"rejected rows are in {report.reject_path}"
        )


class CommitConflict(RuntimeError):
    """Another load changed the table first, again and again."""
