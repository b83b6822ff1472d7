"""Names of stored files, told from columns; null where a part is no valid id, so a bad id never becomes a path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions import scalar as s

#: Forms of analysis keys and engine versions, and the endings of reports and of marks of failed ones.
KEY, ENGINE = r"^v[0-9]+\.[0-9]+\.[0-9]+__(?:auto|v3|v4)\z", r"^[0-9]+\.[0-9]+\.[0-9]+\z"
REPORT, ERROR = ".report.json.gz", ".error.json"


def _path(valid: list[Column], *parts: Column | str) -> Column:
    """The parts put together if all conditions hold."""
    ok = F.lit(True)
    for v in valid:
        ok = ok & F.coalesce(v, F.lit(False))
    return F.when(ok, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))


def _feed(org: Column, feed: Column) -> tuple[list[Column], list[Column | str]]:
    return [s.is_path_id(org), s.is_path_id(feed)], ["feeds/", org, "/", feed]


def feed_path(org: Column, feed: Column) -> Column:
    valid, base = _feed(org, feed)
    return _path(valid, *base, "/feed.json")


def generation_path(org: Column, feed: Column, uid: Column, key: Column) -> Column:
    valid, base = _feed(org, feed)
    return _path([*valid, s.is_uid(uid), key.rlike(KEY)], *base, "/generations/", uid, "/", key, ".json")


def content_path(org: Column, feed: Column, uid: Column) -> Column:
    valid, base = _feed(org, feed)
    return _path([*valid, s.is_uid(uid)], *base, "/generations/", uid, "/content.json")


def source_changed_path(org: Column, feed: Column, uid: Column) -> Column:
    valid, base = _feed(org, feed)
    return _path([*valid, s.is_uid(uid)], *base, "/generations/", uid, "/source-changed.json")


def diff_path(org: Column, feed: Column, key: Column, old: Column, new: Column) -> Column:
    valid, base = _feed(org, feed)
    return _path([*valid, key.rlike(KEY), s.is_uid(old), s.is_uid(new)], *base, "/diffs/", key, "/", old, "__", new, ".json")


def report_path(org: Column, feed: Column, engine: Column, old: Column, new: Column, failed: bool = False) -> Column:
    valid, base = _feed(org, feed)
    return _path([*valid, engine.rlike(ENGINE), s.is_uid(old), s.is_uid(new)], *base, "/changes/", engine, "/", old, "__", new, ERROR if failed else REPORT)
