"""Messages that several tests send."""

SAMPLE = [
    ("NORTH", 41.25, 310, 5200000, "2023-03-07T09:30:00", "EAST"),
    ("SOUTH", 7.5, 1250, 880000, "2023-03-07T09:30:04", "EAST"),
    ("RIVER", 120.0, 45, 99000000, "2023-03-07T09:30:09", "WEST"),
    ("STONE", 63.75, 600, 4100000, "2023-03-07T09:31:00", "WEST"),
]
