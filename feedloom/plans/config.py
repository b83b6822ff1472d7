"""Thresholds and rule tables. Any of them can be replaced key by key; unknown names are refused."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace


@dataclass(frozen=True)
class Matching:
    accept_confidence: float = 0.5
    cross_line_max_shift_min: int = 10
    cross_line_min_containment: float = 0.8
    day_group_min_agreement: float = 0.8
    direction_align: bool = True
    first_last_min_shift: int = 10
    line_family_patterns: tuple[str, ...] = (r"^[\[【「]([^\]】」]+線)[\]】」]",)
    line_max_component: int = 6
    line_min_overlap: float = 0.6
    line_name_pair_min_similarity: float | None = 0.6
    line_name_strip_patterns: tuple[str, ...] = (r"^[A-Z][0-9]*(?=[一-鿿])",)
    pattern_min_similarity: float = 0.4
    stop_group_radius_m: float = 200
    stop_moved_min_m: float = 20
    stop_name_min_similarity: float = 0.6
    stop_name_radius_m: float = 500
    stop_name_strip_patterns: tuple[str, ...] = ("[0-9]+(番線|番のりば|番乗り場|番乗場|番|のりば|乗り場|乗場)$", "(?<=[^A-Za-z0-9])[A-Za-z]$")
    #: Endings of stop names that say which side of a street a stop is on.
    stop_name_suffixes: tuple[str, ...] = ("（上り）", "（下り）", "（上）", "（下）", "上り", "下り", "のりば", "乗り場", "乗場", "バス停", "（往路）", "（復路）", "（往）", "（復）")
    stop_near_radius_m: float = 150
    stop_same_id_max_m: float = 300
    trip_max_cost: float = 0.8
    trip_max_shift_min: int = 45


@dataclass(frozen=True)
class Report:
    date_change_trips_max: int = 30
    date_changes_max: int = 100
    dwell: bool = True
    events: bool = True
    geometry_cap_m: float = 500
    geometry_diverge_m: float = 50
    geometry_sample_m: float = 20
    geometry_tolerance_m: float = 10
    irregular_max: int = 50
    irregular_spans_max: int = 20
    other_details_max: int = 200
    pattern_shifts: bool = True
    renumbering: bool = True


@dataclass(frozen=True)
class Config:
    bulk_threshold: int = 100_000
    max_rows_per_file: int = 5_000_000
    max_uncompressed_bytes: int = 2_147_483_648
    min_overlap_days: int = 14
    special_max_days: int = 8
    compare_from_publication: bool = False
    matching: Matching = field(default_factory=Matching)
    report: Report = field(default_factory=Report)

    def merged(self, overrides: dict) -> Config:
        """Overrides of top-level values and, key by key, of the two sections."""
        known = {f.name for f in fields(self)}
        if unknown := set(overrides) - known:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        parts = {k: replace(getattr(self, k), **v) if k in ("matching", "report") else v for k, v in overrides.items()}
        return replace(self, **parts)


#: Primary keys of schedule files; None is a file of one row.
FIXED_KEYS: dict[str, tuple[str, ...] | None] = {
    "agency.txt": ("agency_id",),
    "stops.txt": ("stop_id",),
    "routes.txt": ("route_id",),
    "trips.txt": ("trip_id",),
    "stop_times.txt": ("trip_id", "stop_sequence"),
    "calendar.txt": ("service_id",),
    "calendar_dates.txt": ("service_id", "date"),
    "fare_attributes.txt": ("fare_id",),
    "shapes.txt": ("shape_id", "shape_pt_sequence"),
    "frequencies.txt": ("trip_id", "start_time"),
    "levels.txt": ("level_id",),
    "pathways.txt": ("pathway_id",),
    "attributions.txt": ("attribution_id",),
    "agency_jp.txt": ("agency_id",),
    "office_jp.txt": ("office_id",),
    "feed_info.txt": None,
}
#: Keys made of those of these columns that both sides have.
OPTIONAL_KEYS: dict[str, tuple[str, ...]] = {
    "transfers.txt": ("from_stop_id", "to_stop_id", "from_trip_id", "to_trip_id", "from_route_id", "to_route_id"),
    "translations.txt": ("table_name", "field_name", "language", "record_id", "record_sub_id", "field_value"),
}
#: Files whose row changes are never summed up.
NEVER_BULK = ("stops.txt", "routes.txt", "trips.txt", "stop_times.txt", "calendar.txt", "calendar_dates.txt", "shapes.txt", "frequencies.txt")
#: Change kinds in the order of their listing.
KINDS = ("file_added", "file_removed", "column_added", "column_removed", "row_added", "row_removed", "field_changed", "file_changed_opaque", "rows_bulk")
#: Categories of calendar days in their order.
CATEGORIES = ("mon", "tue", "wed", "thu", "fri", "sat", "sun", "hol")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
#: What a change of these files is about.
OTHER_TOPICS = {
    "fare_attributes.txt": "fares",
    "fare_rules.txt": "fares",
    "calendar_dates.txt": "calendar_exceptions",
    "agency.txt": "agency",
    "agency_jp.txt": "agency",
    "office_jp.txt": "office",
    "translations.txt": "translations",
    "feed_info.txt": "feed_info",
    "shapes.txt": "shapes",
    "transfers.txt": "transfers",
}
#: The columns that places, lines and trips are made from.
CORE_COLUMNS = {
    "stops.txt": ("stop_id", "stop_name", "stop_lat", "stop_lon", "parent_station", "location_type"),
    "routes.txt": ("route_id", "route_short_name", "route_long_name"),
    "trips.txt": ("trip_id", "route_id", "service_id", "direction_id"),
    "stop_times.txt": ("trip_id", "stop_sequence", "stop_id", "arrival_time", "departure_time"),
}
#: Columns whose change no passenger meets.
TECHNICAL_COLUMNS = {
    "stops.txt": (),
    "routes.txt": ("agency_id", "route_sort_order", "jp_parent_route_id"),
    "trips.txt": ("shape_id", "block_id", "jp_pattern_id", "jp_office_id"),
    "stop_times.txt": ("shape_dist_traveled", "timepoint"),
}
TECHNICAL_TOPICS = ("feed_info", "formatting", "shapes")
TECHNICAL_EXCEPTION_KINDS = ("calendar_outside_shared", "calendar_no_effect", "calendar_unused_service")
ESTIMATE_TECHNICAL_FILES = ("feed_info.txt", "calendar.txt", "calendar_dates.txt")
#: Events that change what passengers can do, always or beyond a share.
MAJOR_EVENTS = ("ROUTE_ADDED", "ROUTE_DISCONTINUED", "ROUTE_MERGED", "ROUTE_SPLIT", "ROUTE_RESTRUCTURED")
MAJOR_IF_SERVED = ("STOP_ADDED", "STOP_REMOVED")
MAJOR_IF_PATTERN_SHARE = ("PATTERN_EXTENDED", "PATTERN_SHORTENED", "DETOUR_ADDED", "DETOUR_REMOVED", "STOP_SKIPPED")
SERVICE_MAJOR_SHARE, SERVICE_MAJOR_TRIPS, PATTERN_MAJOR_SHARE = 0.1, 2, 0.5
#: Licences by the names publishers give them.
LICENSES = {"CC BY 4.0": "CC-BY-4.0", "CC0 1.0": "CC0-1.0", "CC BY 2.1 JP": "CC-BY-2.1-JP", "lov2": "etalab-2.0", "odc-odbl": "ODbL-1.0"}
EARTH_M = 6371008.8
