"""Two publications of a small harbour town, and archives of them."""

from __future__ import annotations

import csv
import io
import zipfile

PLACES = {"h1": ("Harbour", 35.10, 139.50), "h2": ("Market", 35.12, 139.51), "h3": ("Museum", 35.14, 139.52), "h4": ("Station", 35.16, 139.53), "h5": ("Hill", 35.20, 139.60)}
LATER = {"h1": PLACES["h1"], "m2": PLACES["h2"], "h3": ("Art Museum", 35.14, 139.52), "h4": PLACES["h4"], "h6": ("Lake", 35.25, 139.70)}


def text(header: str, rows: list[tuple]) -> str:
    out = io.StringIO()
    write = csv.writer(out, lineterminator="\n")
    write.writerow(header.split())
    write.writerows(rows)
    return out.getvalue()


def clock(minutes: int) -> str:
    return f"{minutes // 60:02}:{minutes % 60:02}:00"


class Town:
    """Files of a publication, a run at a time: every call is ten minutes after the one before."""

    def __init__(self, places: dict, fare: int):
        self.places, self.fare, self.routes, self.trips, self.calls = places, fare, {}, [], []

    def run(self, trip: str, route: str, name: str, service: str, start: int, *stops: str) -> Town:
        self.routes[route] = name
        self.trips.append((trip, route, service, "0"))
        for n, stop in enumerate(stops):
            at = clock(start + 10 * n)
            self.calls.append((trip, 5 * n + 1, stop, at, at))
        return self

    def files(self) -> dict[str, str]:
        workdays, sundays = ("1",) * 6 + ("0",), ("0",) * 6 + ("1",)
        week = "monday tuesday wednesday thursday friday saturday sunday"
        return {
            "agency.txt": text("agency_id agency_name agency_url agency_timezone", [("t", "Town", "https://t.example", "Asia/Tokyo")]),
            "stops.txt": text("stop_id stop_name stop_lat stop_lon", [(k, *v) for k, v in self.places.items()]),
            "routes.txt": text("route_id route_short_name route_long_name route_type", [(k, v, "", 3) for k, v in self.routes.items()]),
            "trips.txt": text("trip_id route_id service_id direction_id", self.trips),
            "stop_times.txt": text("trip_id stop_sequence stop_id arrival_time departure_time", self.calls),
            "calendar.txt": text(f"service_id {week} start_date end_date", [("D", *workdays, 20270201, 20270331), ("S", *sundays, 20270201, 20270331)]),
            "fare_attributes.txt": text("fare_id price currency_type payment_method transfers", [("one", self.fare, "JPY", 0, "")]),
        }


ROUND = ("h1", "h2", "h3", "h4")
AROUND = ("h1", "m2", "h3", "h4")
OLD = (
    Town(PLACES, 150).run("a1", "red1", "Red", "D", 420, *ROUND).run("a2", "red1", "Red", "D", 480, *ROUND).run("a3", "red1", "Red", "S", 540, *ROUND)
    .run("b1", "blu", "Blue", "D", 600, "h4", "h5").run("b2", "blu", "Blue", "D", 900, "h4", "h3", "h1").files()
)
NEW = (
    Town(LATER, 180).run("a1", "red9", "Red", "D", 420, *AROUND).run("a2", "red9", "Red", "D", 487, *AROUND).run("a3", "red9", "Red", "S", 540, *AROUND).run("a4", "red9", "Red", "D", 1080, *AROUND)
    .run("b1", "blu", "Blue", "D", 600, "h4", "h6").run("g1", "grn", "Green", "D", 903, "h4", "h3").files()
)


def archive(files: dict[str, str | bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in files.items():
            z.writestr(name, body)
    return out.getvalue()
