"""Business values as data: status tables, calendars, rate cards.

Everything in this file is a fixed value set that results depend on. Callers may
pass their own version of any of these to the operators.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------- statuses
# Raw scan status -> canonical status; a status not listed stays as it is.
CANONICAL_STATUS = {
    "Order Assigned": "Shipment Created",
    "Awb Generated": "Shipment Created",
    "RTO In-transit": "RTO In-Transit",
    "Last-Mile": "Last Mile",
    "Failed Delivery": "Failed Delivered",
    "Transit Damage": "Damaged",
    "In-transit": "In-Transit",
    "Out For Delivery": "Out for Delivery",
    "Reached Nearest Hub": "Last Mile",
    "RTO Reached Nearest Hub": "RTO In-Transit",
    "Failed & Action Required": "Failed Delivered",
    "Picked-up": "Picked Up",
}

# Who holds the parcel, by raw scan status.
CUSTODY = {
    "Fulfillment Centre": ["Shipment Created", "Awb Generated", "Shipment Failed", "Cancelled",
                           "Pickup Failed", "Out for Pickup", "RTO Delivered"],
    "Mother Hub": ["Picked from Rack", "Packed"],
    "Hub": ["Picked-up", "Reached City Hub", "Add to bag", "Reached Destination City",
            "Reached Nearest Hub"],
    "Sort to Bin": ["Sort to Bin"],
    "End Customer": ["Delivered"],
    "Lost": ["Lost"],
    "Mid Mile": ["Bag-Dispatched from Hub", "In-Transit"],
    "Rider": ["Out for Delivery", "Failed Delivered"],
    "RTO Vehicle": ["RTO Out for Delivery"],
}
# These scans do not move the parcel.
NO_MOVE = ["NDR Initiated", "RTO Initiated", "RTO Freeze", "Failed Delivered Collected"]
PICKED_UP_RAW, FIRST_MILE = "Picked-up", "FM Vehicle"

# Client-facing short status. The first table holds for every carrier.
SHORT_STATUS = {
    "Shipment Failed": "SF", "Shipment Created": "PP", "Order Assigned": "PP",
    "Out for Pickup": "PP", "Pickup Failed": "PP", "Awb Generated": "PP",
    "Picked-up": "IN", "In-Transit": "IN", "Reached Destination City": "IN",
    "Reached Nearest Hub": "IN", "Delivery Delay": "ND", "Out for Delivery": "OFD",
    "Failed Delivered": "ND", "Failed & Action Required": "ND", "Transit Damage": "TD",
    "Delivered": "DL", "RTO Initiated": "RTO IN", "RTO In-Transit": "RTO IN",
    "RTO Out for Delivery": "RTO OFD", "RTO Not Delivered": "RTO ND", "RTO Delivered": "RTO DL",
    "Lost": "LT", "Cancelled": "CN", "Status Not Defined": "SND",
    "Delivered - To be RTO": "SND", "Lost - POD Not Available": "SND", "NDR Initiated": "NDR",
}
# Additions for the own network and for partner carriers.
SHORT_STATUS_OWN = {"RTO Freeze": "RTO"}
SHORT_STATUS_PARTNER = {
    "Damaged": "DAM", "Packed Warehouse": "PP", "RTO Delivery Delay": "RTO ND",
    "RTO Failed Delivered": "RTO ND", "RTO Reached Nearest Hub": "RTO IN",
}
SHORT_STATUS_UNKNOWN = "SND"

# Statuses that end a shipment.
CLOSED_STATUSES = ["Delivered", "RTO Delivered", "Lost", "Cancelled"]
AGEING_EXCLUDED = ["Cancelled", "Lost", "Delivered", "RTO Delivered", "Damaged"]

# ---------------------------------------------------------------- parties and places
# Carrier id -> name.
OWN_CARRIER_ID, OWN_CARRIER = 301, "Hyperlocal"
CARRIERS = {
    1: "Shadowfax", 2: "Delhivery", 3: "Xpressbees", 4: "FedEx", 5: "Bluedart",
    6: "Smartr", 7: "Ekart", 8: "DTDC", 301: "Hyperlocal", 1001: "B2B",
}
# The finance table does not know the business carrier by name.
FINANCE_CARRIERS = {k: v for k, v in CARRIERS.items() if k != 1001}
# City code -> city.
CITY_CODES = {"DEL": "Delhi", "BLR": "Bangalore", "HYD": "Hyderabad", "NCR": "NCR",
              "BOM": "Mumbai", "JPR": "Jaipur"}
# City spellings of warehouses.
CITY_GROUPS = {
    "Delhi": ["DELHI", "New Delhi", "Delhi", "North Delhi", "Yamuna Nagar", "North West Delhi",
              "South Delhi", "Dwarka", "Gurgaon", "Gurugram", "South East Delhi", "Mahendragarh",
              "South West Delhi", "Rewari", "Jhajjar", "Gurgaon "],
    "Bangalore": ["Bangalore", "Bangalore Rural", "Bengaluru", "Bangalore "],
    "Mumbai": ["Mumbai", "Thane"],
    "Hyderabad": ["K.V.Rangareddy"],
}
MERGED_CITIES = {"Delhi": ["NCR"]}
# Messages go out in this language for these cities, else in English.
HINDI_CITIES = ["Jaipur", "Delhi", "Mumbai"]
# Marks of franchise hubs in hub names.
FRANCHISE_MARKS = ["frh", "franchise"]

# ---------------------------------------------------------------- warehouse stages
# Log status -> milestone, and stage order.
PICK_PACK = {"assigned_time": ["Order Assigned", "STO Assigned"], "picked_time": ["Picked"],
             "packed_time": ["Packed"], "dispatched_time": ["Left Warehouse"]}
STAGE_ORDER = {"Order Assigned": 1, "Picked": 2, "Packed": 3, "Left Warehouse": 4}
NOT_YET_SHIPPED = ["Awb Generated", "Order Assigned", "Out for Pickup", "Pickup Failed",
                   "Shipment Created"]

# ---------------------------------------------------------------- delivery promises
@dataclass(frozen=True)
class Promise:
    """Picked up before ``before_hour``: due ``days`` later at ``due_hour``."""
    before_hour: int
    days: int
    due_hour: int


# Promise by lane; the last entry of each list has no upper bound.
LANE_PROMISES = {
    "special": [Promise(22, 1, 18), Promise(24, 2, 18)],
    "Within Zone": [Promise(21, 1, 12), Promise(24, 2, 12)],
    "Metro": [Promise(15, 1, 12), Promise(24, 2, 12)],
    "Intracity": [Promise(3, 0, 12), Promise(11, 0, 18), Promise(24, 1, 12)],
    "other": [Promise(24, 1, 18)],
}
SPECIAL_LANE = ("Bangalore", "Hyderabad")
# Second attempt after a failed one.
WRONG_ADDRESS = "wrong address"
REATTEMPT_WRONG_ADDRESS = Promise(24, 2, 12)
REATTEMPT = [Promise(14, 1, 12), Promise(24, 1, 18)]
# Customer replies.
REATTEMPT_REQUESTED = "Reattempt Requested"
REPLY_SLOTS = {"Evening": "evening", "Afternoon": "evening", "4PM - 10PM": "evening",
               "9AM - 4PM": "morning", "Morning": "morning"}
EVENING_DUE_HOUR, OTHER_DUE_HOUR = 18, 12

# ---------------------------------------------------------------- pending work
# Shipment status -> pending-work class where no further test is needed.
ACTION_BY_STATUS = {
    "Reached Nearest Hub": "fresh_attempt", "NDR Initiated": "reattempt",
    "Failed Delivered": "ndr_required", "RTO Freeze": "RTO OFD",
    "RTO Out for Delivery": "RTO Delivery", "Lost": "Lost",
}
PICKUP_STATUSES = ["Awb Generated", "Order Assigned", "Picked-up", "Packed"]
OUTLIER_HOURS = 240
HEAVY_GRAMS, HEAVY_GRAMS_PRODUCTIVITY = 2000, 1800

# ---------------------------------------------------------------- improvement program
# Slot, payment, success threshold.
PROGRAM_THRESHOLDS = [("Morning", "Prepaid", 0.85), ("Morning", "COD", 0.6),
                      ("Evening", "Prepaid", 0.8), ("Evening", "COD", 0.5)]
# How a weak cell is written, in front of the percentage.
PROGRAM_TEXT = {("Morning", "Prepaid"): "Morning Prepaid (", ("Morning", "COD"): "Morning COD(",
                ("Evening", "Prepaid"): "Evening Prepaid (", ("Evening", "COD"): "Evening COD ("}
PROGRAM_ENTRY_FASR, PROGRAM_MIN_ORDERS, PROGRAM_MIN_AGE_DAYS = 0.84, 3, 10

# ---------------------------------------------------------------- rider stars
# Remark by number of stars.
STAR_REMARKS = {
    0: "Improvement required, focus on all areas.",
    1: "Below expectations, work on improvement.",
    2: "Improvement needed, aim for better.",
    3: "Average performance, keep improving.",
    4: "Great job, 1 more star to go!",
    5: "Outstanding performance, top-notch work!!",
}

# ---------------------------------------------------------------- rate cards
@dataclass(frozen=True)
class Slab:
    """Up to and including ``upto`` deliveries: base + rate * (deliveries - beyond)."""
    city: str
    upto: int | None
    base: float
    rate: float = 0
    beyond: int = 0


@dataclass(frozen=True)
class Guarantee:
    """At least ``at_least`` of ``measure``: the day pays at least ``amount``."""
    city: str
    measure: str
    at_least: int
    amount: float
    hub: str | None = None


@dataclass(frozen=True)
class OrderCard:
    """Pay per order. ``pincode_cities`` add the pincode rate; bands are tried in order."""
    base: dict
    pincode_cities: tuple
    weight_bands: dict
    failed_visit: dict
    evening: dict
    client_base: dict
    special_clients: tuple = ()


# Day pay of fixed-pay riders.
SLABS = {
    "april": [
        Slab("Mumbai", 3, 0, 45), Slab("Mumbai", None, 642),
        Slab("Delhi", 5, 0, 50), Slab("Delhi", 20, 640), Slab("Delhi", 30, 640, 10, 20),
        Slab("Delhi", 40, 740, 15, 30), Slab("Delhi", 50, 890, 20, 40), Slab("Delhi", None, 1090),
        Slab("Bangalore", 5, 0, 35), Slab("Bangalore", 20, 690), Slab("Bangalore", 30, 690, 5, 20),
        Slab("Bangalore", 40, 740, 10, 30), Slab("Bangalore", 50, 840, 15, 40),
        Slab("Bangalore", None, 990, 20, 50),
        Slab("Hyderabad", 3, 0, 45), Slab("Hyderabad", 15, 750), Slab("Hyderabad", None, 750, 15, 15),
        Slab("Jaipur", 2, 0, 30), Slab("Jaipur", 20, 540), Slab("Jaipur", 30, 540, 10, 20),
        Slab("Jaipur", 40, 640, 15, 30), Slab("Jaipur", 50, 790, 20, 40), Slab("Jaipur", None, 990),
    ],
    "legacy": [
        Slab("Mumbai", 3, 0, 45), Slab("Mumbai", None, 769),
        Slab("Delhi", 1, 0, 30), Slab("Delhi", None, 692),
        Slab("Bangalore", 3, 0, 35), Slab("Bangalore", 20, 690), Slab("Bangalore", 30, 690, 10, 20),
        Slab("Bangalore", 40, 790, 15, 30), Slab("Bangalore", 50, 940, 20, 40),
        Slab("Bangalore", None, 1140, 25, 50),
        Slab("Hyderabad", 0, 0), Slab("Hyderabad", 15, 750), Slab("Hyderabad", None, 750, 15, 15),
    ],
}
SLABS["zone"] = SLABS["april"]

# Minimum day guarantee, first match wins.
GUARANTEES = {
    "april": [
        Guarantee("Delhi", "delivered", 10, 500),
        Guarantee("Mumbai", "delivered", 15, 750, hub="DS BOM KDWL"),
        Guarantee("Mumbai", "delivered", 5, 600),
        Guarantee("Hyderabad", "delivered", 3, 600),
        Guarantee("Bangalore", "evening_delivered", 15, 500),
    ],
    "zone": [
        Guarantee("Delhi", "delivered", 10, 500),
        Guarantee("Mumbai", "delivered", 5, 750, hub="DS BOM KDWL"),
        Guarantee("Mumbai", "delivered", 5, 600),
        Guarantee("Hyderabad", "delivered", 3, 600),
        Guarantee("Bangalore", "evening_delivered", 5, 500),
    ],
    "legacy": [Guarantee("Mumbai", "delivered", 3, 600)],
}
# Later correction of the guarantee, by hub.
GUARANTEE_FIX_MIN_DELIVERED = 5
GUARANTEE_FIX = {"DS BOM KDWL": 750, "DS BOM SWRI": 600, "DS BOM KRL": 600, "DS BOM THAN": 600}
GUARANTEE_FIX_CITY = "Mumbai"

# Pay per order.
ORDER_CARDS = {
    "april": OrderCard(
        base={"Mumbai": 26, "Delhi": 20, "Bangalore": 27, "Hyderabad": 30},
        pincode_cities=("Delhi",),
        weight_bands={"Mumbai": [(5000, 60), (3000, 30)], "Delhi": [(4000, 30)]},
        failed_visit={}, evening={"Delhi": 5}, client_base={}),
    "legacy": OrderCard(
        base={"Mumbai": 30, "Delhi": 20, "Bangalore": 22},
        pincode_cities=("Mumbai", "Delhi"),
        weight_bands={"Bangalore": [(350, 8), (600, 13), (2100, 28), (5100, 68)],
                      "Mumbai": [(5000, 60), (3000, 30)], "Delhi": [(4000, 25)]},
        failed_visit={"Mumbai": 10}, evening={"Delhi": 10, "Mumbai": 15},
        client_base={"Delhi": 25, "Mumbai": 20, "Bangalore": 22},
        special_clients=(234, 340, 339, 338, 341)),
}
ORDER_CARDS["zone"] = ORDER_CARDS["april"]
OPERATIONAL_CONSTRAINT = "operational constraint"
EVENING_HOUR = 15

# Franchise pay per delivered order, (city, hubs or None for the rest, amount).
FRANCHISE_BASE = [
    ("Bangalore", ["BLR FRH ECTY", "BLDR-Franchise"], 35),
    ("Bangalore", None, 38),
    ("Delhi", ["GGKC-Franchise", "SNSR-Franchise"], 30),
    ("Delhi", ["RHNP-Franchise", "ONFC-Franchise", "FBD-Franchise", "FABD-Franchise"], 35),
    ("Delhi", ["APAN-Franchise"], 32),
    ("Delhi", None, 33),
    ("Mumbai", ["GRGN-Franchise"], 40),
    ("Hyderabad", None, 38),
]
# Franchise weight pay, (city, hubs or None, grams above, amount), first match wins.
FRANCHISE_WEIGHT = [
    ("Delhi", None, 4000, 30), ("Delhi", None, 7000, 60),
    ("Bangalore", ["BLR FRH ECTY", "BLDR-Franchise"], 3000, 45), ("Bangalore", None, 3000, 40),
    ("Mumbai", None, 3000, 40), ("Hyderabad", None, 3000, 40),
]

# Success-rate bonus per delivered order, first match wins.
FASR_BONUS = [(0.9, 2), (0.85, 1)]
@dataclass(frozen=True)
class Attendance:
    """Deliveries that count as present, deliveries of a full day, full days needed by city."""
    present_from: int
    bonus_from: int
    days: dict
    days_other: int


# Attendance bonus.
ATTENDANCE_BONUS = 1000
ATTENDANCE = {
    "april": Attendance(3, 4, {"Mumbai": 28, "Bangalore": 28}, 26),
    "zone": Attendance(3, 4, {"Mumbai": 28, "Bangalore": 28}, 26),
    "legacy": Attendance(2, 0, {}, 26),
}
# Unbroken-attendance windows by city as (first day, last day) of the month.
UNBROKEN_WINDOWS = {
    "longer-consecutive-attendance": {"Mumbai": (8, 19), "Bangalore": (6, 19), "Hyderabad": (7, 19)},
    "shorter-consecutive-attendance": {"Mumbai": (8, 16), "Bangalore": (10, 16), "Hyderabad": (10, 16)},
}
UNBROKEN_EXCLUDED_CITY, UNBROKEN_BONUS = "Delhi", 1000
# Fuel pay needs this delivered share; vendors take this share of order pay.
FUEL_MIN_DELIVERED_SHARE = 0.4
VENDOR_SHARE = 0.06
# Cost masters.
THIRD_PARTY_WAREHOUSE_VENDOR = "3WH"
MONTH_DAYS_FOR_MID_MILE = 30
