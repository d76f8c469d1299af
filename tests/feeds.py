"""Feed documents for tests."""

from __future__ import annotations

import json


def neo(number, day="2024-01-01", approaches=1, **changes):
    """One object; its approaches differ in the body, so that the first can be told."""
    found = {
        "id": str(number),
        "name": f"({number})",
        "nasa_jpl_url": f"https://example.org/{number}",
        "absolute_magnitude_h": 20.5,
        "estimated_diameter": {
            unit: {"estimated_diameter_min": scale, "estimated_diameter_max": 2 * scale}
            for unit, scale in (("kilometers", 0.5), ("meters", 500), ("miles", 0.3), ("feet", 1640.4))
        },
        "is_potentially_hazardous_asteroid": True,
        "close_approach_data": [
            {
                "close_approach_date": day,
                "close_approach_date_full": f"{day} 01:02",
                "epoch_date_close_approach": 1704067200000,
                "relative_velocity": {
                    "kilometers_per_second": "10.7",
                    "kilometers_per_hour": 38520,
                    "miles_per_hour": "23935.1",
                },
                "miss_distance": {
                    "astronomical": "0.1",
                    "lunar": "38.9",
                    "kilometers": 14959787.07,
                    "miles": "9295581",
                },
                "orbiting_body": "Earth" if place == 0 else f"other {place}",
            }
            for place in range(approaches)
        ],
        "is_sentry_object": False,
    }
    found.update(changes)
    return found


def document(days, count=None):
    """A document of day to objects; the count is that of the first day unless given."""
    if count is None:
        count = len(next(iter(days.values()), []))
    return json.dumps({"element_count": count, "near_earth_objects": days})


def land(folder, name, *documents):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("\n".join(documents) + "\n")
    return path
