import pytest
from conftest import values
from pyspark.sql import functions as F

from haulmark import rules
from haulmark.functions import clock
from haulmark.operators import aggregate, attempts, cash, cohort, fulfilment, margin, payout, report, service, tracking
from haulmark.plans import pay


def scans(rows, data):
    """(id, status, hour, location, remark) of one shipment."""
    return rows([(i, 1, s, f"2024-01-0{1 + h // 24} {h % 24:02d}:00:00", loc, rem) for i, s, h, loc, rem in data],
                "tracking_id long, shipment_id long, shipment_status string, update_time ts, location string, remark string")


def facts(rows, data, *columns):
    return values(tracking.tracking_events(scans(rows, data), hot=None), *columns)[0]


def test_imputation_order(rows):
    cols = ("pickup_time", "first_ofd", "closed", "no_pickup_attempts")
    assert facts(rows, [(1, "Picked-up", 1, None, None), (2, "In-Transit", 2, None, None)], *cols) == ("2024-01-01 01:00:00", None, 0, 1)
    assert facts(rows, [(1, "In-Transit", 2, None, None)], *cols) == ("2024-01-01 02:00:00", None, 0, 1)
    assert facts(rows, [(1, "Out for Delivery", 10, None, None)], *cols) == ("2024-01-01 06:00:00", "2024-01-01 10:00:00", 0, 1)
    assert facts(rows, [(1, "Delivered", 10, None, None)], *cols) == (None, "2024-01-01 06:00:00", 1, 0)
    assert facts(rows, [(1, "Lost", 10, None, None)], *cols) == (None, None, 0, 0)


def test_failures_before_first_attempt_do_not_count(rows):
    data = [(1, "Failed Delivered", 1, None, "early"), (2, "Out for Delivery", 2, None, None), (3, "Out for Delivery", 3, None, None),
            (4, "Failed Delivered", 4, None, "one"), (5, "Failed Delivered", 5, None, "two"), (6, "Out for Delivery", 6, None, None), (7, "Failed & Action Required", 7, None, "three")]
    got = facts(rows, data, "no_attempts", "first_ofd", "last_ofd", "first_failed_delivered_remarks", "last_failed_delivered_remarks")
    assert got == (2.0, "2024-01-01 02:00:00", "2024-01-01 06:00:00", "one", "three")


def test_place_ignores_scans_that_move_nothing(rows):
    got = facts(rows, [(1, "Picked-up", 1, "", "van"), (2, "NDR Initiated", 2, "X", None)], "last_location", "last_remark")
    assert got == ("FM Vehicle", "van")


def test_pickup_attempts(rows):
    got = facts(rows, [(1, "Pickup Failed", 1, None, None), (2, "Pickup Failed", 2, None, None), (3, "Picked-up", 3, "L", None)],
                "first_pickup_attempt_time", "last_pickup_attempt_time", "no_pickup_attempts")
    assert got == ("2024-01-01 01:00:00", "2024-01-01 03:00:00", 3)


def test_lane_cities(rows):
    got = facts(rows, [(1, "In-Transit", 1, "BLR / A>BLR / B", None), (2, "In-Transit", 2, "DEL / A>BOM / B", None)],
                "intracity_in_transit_time", "intercity_in_transit_time")
    assert got == ("2024-01-01 01:00:00", "2024-01-01 02:00:00")


@pytest.mark.parametrize("zone,wh,city,at,due", [
    ("Metro", "A", "B", "14:59", "2024-01-02 12:00:00"), ("Metro", "A", "B", "15:00", "2024-01-03 12:00:00"),
    ("Within Zone", "A", "B", "20:59", "2024-01-02 12:00:00"), ("Within Zone", "A", "B", "21:00", "2024-01-03 12:00:00"),
    ("Intracity", "A", "A", "02:59", "2024-01-01 12:00:00"), ("Intracity", "A", "A", "03:00", "2024-01-01 18:00:00"),
    ("Intracity", "A", "A", "10:59", "2024-01-01 18:00:00"), ("Intracity", "A", "A", "11:00", "2024-01-02 12:00:00"),
    ("Metro", "Bangalore", "Hyderabad", "21:59", "2024-01-02 18:00:00"), ("Metro", "Bangalore", "Hyderabad", "22:00", "2024-01-03 18:00:00"),
    (None, "A", "B", "23:00", "2024-01-02 18:00:00")])
def test_promises(rows, zone, wh, city, at, due):
    df = rows([(zone, wh, city, f"2024-01-01 {at}:00")], "shipping_zone string, warehouse_city string, shipping_city string, dispatch_time ts")
    assert values(attempts.attempt_promise(df), "min_reattempt_time") == [(due,)]


def test_ideal_next_attempt(rows):
    base = "2024-01-03 12:00:00"
    df = rows([(1, 0, base, None, None), (2, 1, base, None, None), (3, 1, base, "2024-01-05 00:00:00", "morning"), (4, 1, base, "2024-01-01 00:00:00", None),
               (5, 1, base, "2024-01-01 00:00:00", "evening")], "id int, attempt_number int, min_reattempt_time ts, deferred_date ts, re_attempt_slot string")
    assert values(attempts.ideal_next_attempt(df), "id", "ideal_next_attempt_time") == [
        (1, base), (2, None), (3, "2024-01-05 12:00:00"), (4, base), (5, "2024-01-03 18:00:00")]


def test_on_time_and_outlier(rows):
    df = rows([(1, "2024-01-02 23:00:00", "2024-01-02 01:00:00"), (2, "2024-01-03 00:00:00", "2024-01-02 23:00:00"), (3, None, "2024-01-02 00:00:00")], "id int, a ts, p ts")
    assert values(df.select("id", service.on_time("a", "p").alias("v"))) == [(1, 1), (2, 0), (3, None)]
    assert values(df.select("id", service.on_time_known("a", "p").alias("v"))) == [(1, 1), (2, 0), (3, 0)]


def test_lost_spelling(rows):
    df = rows([("c", "Lost", "x1"), ("c", "pickup", "x2"), ("c", "pickup", "x2")], "city string, action_bucket string, awb string")
    assert values(service.pending_counts(df, ["city"]), "pickup_pending", "lost_marked") == [(1, 1)]
    assert values(service.pending_counts(df, ["city"], literal_lost=True), "lost_marked") == [(0,)]


SLAB_CASES = {
    "april": {"Mumbai": {0: 0, 3: 135, 4: 642}, "Delhi": {5: 250, 6: 640, 20: 640, 21: 650, 30: 740, 31: 755, 40: 890, 41: 910, 50: 1090, 51: 1090},
              "Bangalore": {5: 175, 6: 690, 20: 690, 30: 740, 40: 840, 50: 990, 51: 1010}, "Hyderabad": {3: 135, 4: 750, 15: 750, 16: 765},
              "Jaipur": {2: 60, 3: 540, 20: 540, 30: 640, 40: 790, 50: 990, 60: 990}, "Nowhere": {9: 0}},
    "legacy": {"Mumbai": {3: 135, 4: 769}, "Delhi": {1: 30, 2: 692}, "Bangalore": {3: 105, 20: 690, 30: 790, 40: 940, 50: 1140, 51: 1165}, "Hyderabad": {0: 0, 1: 750, 16: 765}},
}


@pytest.mark.parametrize("card", list(SLAB_CASES))
def test_slabs(rows, card):
    cases = [(c, d, float(v)) for c, m in SLAB_CASES[card].items() for d, v in m.items()]
    df = rows(cases, "city string, d int, expected double")
    got = df.withColumn("pay", payout.slab_pay(F.col("d"), F.col("city"), rules.SLABS[card]))
    assert values(got.filter("pay <> expected")) == []


def orders(rows, data):
    return rows(data, "task_id int, status string, payout_structure string, city string, hub string, rider_id int, dispatch_time ts, chargeable_weight double, "
                      "delivered_rate double, cancellation_remarks string, user_id int, slot string, order_type string, fuel_amount double")


def test_shadowed_weight_bands_stay_shadowed(rows):
    df = orders(rows, [(1, "COMPLETED", "ORDER", "Bangalore", "h", 1, "2024-04-01 10:00:00", 9000.0, None, None, 1, "morning", "Fresh", 0.0)])
    assert values(payout.order_pay(df, rules.ORDER_CARDS["legacy"]), "weight_incentive") == [(8.0,)]


def test_guarantee_and_allocation(rows):
    day = "2024-04-01 10:00:00"
    data = [(i, "COMPLETED", "ORDER", "Hyderabad", "h", 1, day, None, None, None, 1, "morning", "Fresh", 1.5) for i in range(4)]
    data += [(10 + i, "COMPLETED", "FIXED", "Mumbai", "m", 2, day, None, None, None, 1, "morning", "Fresh", 0.0) for i in range(5)]
    data += [(20, "CANCELLED", "ORDER", "Hyderabad", "h", 1, day, None, None, None, 1, "morning", "Fresh", 0.0)]
    paid = payout.order_pay(orders(rows, data).withColumn("awb", F.col("task_id")), rules.ORDER_CARDS["april"])
    days = payout.rider_day(paid, "april")
    assert values(days, "rider_id", "delivered", "attempted", "order_earning", "mg_payed", "fixed_pay", "total_pay") == [
        (1, 4, 5, 120.0, 480.0, 0.0, 600.0), (2, 5, 5, 0.0, 0.0, 642.0, 642.0)]
    costs = payout.allocate_to_orders(paid, days, hot=1)
    per_rider = costs.groupBy("rider_id").agg(F.round(F.sum(F.col("awb_pay") - F.col("fuel_amount")), 6).alias("s"))
    assert values(per_rider, "rider_id", "s") == [(1, 600.0), (2, 642.0)]


def test_fuel_per_task(rows):
    df = rows([("t1", "true", 100.0, 4), ("t2", "false", 100.0, 4), ("t3", "true", 100.0, 0), ("t4", "true", None, 2)], "tour_id string, fuel_payout_automation string, fuel_payout double, completed_tasks int")
    assert values(payout.fuel_per_task(df), "tour_id", "fuel_amount") == [("t1", 25.0), ("t2", 0.0), ("t3", 0.0), ("t4", 0.0)]


def test_pay_input_carries_fuel_and_weight(rows):
    from haulmark.plans import pay
    attempts_ = rows([(1, "a", "COMPLETED", 1, "2024-04-02 16:00:00", 0.0, "t1", None), (2, "a", "CANCELLED", 1, "2024-04-01 10:00:00", 5.0, "t9", None), (3, "a", "COMPLETED", 1, "2024-03-01 10:00:00", 5.0, "t9", None)],
                     "task_id int, awb string, status string, rider_id int, dispatch_time ts, cod_amount double, tour_id string, cancellation_remarks string")
    headers = rows([("a", 7, "Delhi", 110001, 100.0)], "awb string, user_id int, warehouse_city string, pincode int, shipment_chargeable_weight double")
    weights = rows([("a", 10.0, 10.0, 100.0, 50.0), ("a", 1.0, 1.0, 1.0, 4500.0)], "shipment_awb string, length double, breadth double, height double, weight double")
    info = rows([(1, "Hub", "Delhi", "ORDER")], "rider_id int, hub string, city string, payout_structure string")
    rates = rows([(110001, 2.5)], "pincode int, delivered_rate double")
    fuel = rows([("t1", 3.0)], "tour_id string, fuel_amount double")
    for hot in (None, 1):
        out = pay.pay_input(attempts_, headers, weights, info, rates, fuel, month="2024-04-01", hot=hot)
        assert values(out, "task_id", "attempt_number", "chargeable_weight", "delivered_rate", "slot", "fuel_amount") == [
            (1, 2, 4500.0, 2.5, "evening", 3.0), (2, 1, 4500.0, 2.5, "morning", 0.0)]
        paid = payout.order_pay(out, rules.ORDER_CARDS["april"])
        assert values(paid, "task_id", "delivery_incentive", "weight_incentive", "evening_order_incentive") == [(1, 22.5, 30.0, 5.0), (2, 0.0, 0.0, 0.0)]


def test_bonus_counts_fresh_orders(rows):
    """The success bonus follows the intended spelling of the order type."""
    data = [(i, "COMPLETED", "ORDER", "Mumbai", "m", 1, "2024-04-01 10:00:00", None, None, None, 1, "morning", "Fresh", 0.0) for i in range(5)]
    table = payout.payout_table(payout.rider_day(payout.order_pay(orders(rows, data), rules.ORDER_CARDS["zone"]), "zone"))
    assert values(table, "fasr", "fasr_pay", "key") == [(1.0, 10.0, "1-2024-04-01-m")]


def test_unbroken_attendance(rows):
    data = [("Mumbai", 1, f"2023-11-{d:02d} 00:00:00", 1) for d in range(8, 20)] + [("Mumbai", 2, f"2023-11-{d:02d} 00:00:00", 1) for d in range(8, 17)]
    data += [("Jaipur", 3, "2023-11-01 00:00:00", 1), ("Delhi", 4, "2023-11-01 00:00:00", 1)]
    got = values(payout.unbroken_attendance(rows(data, "city string, rider_id int, dispatch_date ts, delivered int"), "2023-11-01"), "rider_id", "type")
    assert got == [(1, "longer-consecutive-attendance"), (1, "shorter-consecutive-attendance"), (2, "shorter-consecutive-attendance"),
                   (3, "longer-consecutive-attendance"), (3, "shorter-consecutive-attendance")]


def test_loss_remarks(rows):
    df = rows([("a", "Lost on Hub: 12. x"), ("b", "Lost on Rider:7."), ("c", "Lost on Hub: 12"), ("d", "Lost on FM: x"), ("e", "other")], "awb string, remark string")
    assert values(cash.classify_loss(df), "awb", "attribution", "lost_node_id", "lost_rider_id") == [
        ("a", "Hub", "12", None), ("b", "Rider", None, "7"), ("c", "Hub", None, None), ("d", "FM", None, None)]


def test_stage_dedup(rows):
    df = rows([("1", 1, "a", "Packed", 2), ("2", 1, "a", "Picked", 3), ("3", 2, "b", "Unknown", 1), ("4", 2, "b", "Left Warehouse", 1), ("5", None, "z", "Packed", 9)],
              "id string, shipment_id int, awb string, status string, quantity int")
    assert values(fulfilment.stage_dedup(df), "shipment_id", "status", "quantity_sum") == [(1, "Packed", 5), (2, "Unknown", 2)]


def test_total_row_takes_ratio_of_sums(rows):
    df = rows([("a", 1.0, 1), ("b", 1.0, 3)], "city string, v double, n int")
    out = aggregate.with_total(df, "city", {"v": F.sum("v"), "n": F.sum("n")}, ratios={"r": ("v", "n")})
    assert values(out, "city", "r") == [("Total", 0.5), ("a", 1.0), ("b", 1 / 3)]
    empty = aggregate.with_total(df.filter("n > 9"), "city", {"v": F.sum("v"), "n": F.sum("n")})
    assert values(empty, "city", "v") in ([], [("Total", None)])


def test_lane_allocation_spreads_all_local_cost(rows):
    lanes = rows([("A", "A", 10), ("A", "B", 5), ("C", "C", 1)], "warehouse_city string, city string, orders int")
    costs = rows([("A", "A", "Hyperlocal", 100.0), ("A", "B", "Intercity", 50.0)], "warehouse_city string, shipping_city string, lane_type string, cost double")
    out = margin.lane_cost_allocation(lanes, costs)
    assert values(out, "warehouse_city", "city", "total_mm_cost") == [("A", "A", 8.0), ("A", "B", 14.0), ("C", "C", None)]
    total = out.agg(F.sum(F.col("orders") * (F.col("self_mm_fm_cpo") + F.col("intercity_fm_cpo")))).first()[0]
    assert total == 100.0


def test_return_factor(rows):
    costs = rows([("A", 100.0), ("B", 100.0)], "shipping_city string, cost double")
    rev = rows([("A", "1", "Delivered"), ("A", "2", "RTO Delivered"), ("B", "3", "Delivered")], "shipping_city string, awb string, shipment_status string")
    factors = margin.return_weighted_factor(costs, margin.return_share(rev))
    assert values(factors, "shipping_city", "r_factor") == [("A", 33.33), ("B", None)]
    assert values(margin.mid_mile_cpo(rev, factors), "awb", "fm_mm_cpo") == [("1", 33.33), ("2", 66.66), ("3", None)]


def test_scorecard_without_data(rows):
    cohort_rows = rows([("2024-03-04 00:00:00", "c", 1, "n", "h")], "pip_date ts, shipping_city string, rider_id int, rider_name string, hub string").withColumn("pip_date", F.col("pip_date").cast("date"))
    ranked = rows([(1, "t", 1, "COMPLETED", 0.0, "c", "2024-03-05 09:00:00", 1)], "rider_id int, tour_id string, attempt_number int, status string, cod_amount double, shipping_city string, dispatch_time ts, task_id int")
    start = values(cohort.cohort_scorecard(cohort_rows, ranked), "performance_type", "status")
    close = values(cohort.cohort_scorecard(cohort_rows, ranked, closing=True), "performance_type", "status")
    assert start == [(t, "pass") for t in ("Evening-COD", "Evening-Prepaid", "Morning-COD", "Morning-Prepaid")]
    assert close == [("Evening-COD", "fail"), ("Evening-Prepaid", "fail"), ("Morning-COD", "fail"), ("Morning-Prepaid", "pass")]


def test_program_life_cycle(rows):
    from haulmark.operators.cohort import close_week, finalise
    df = rows([("k1", "2024-03-04 00:00:00", 1, "running", "failed"), ("k2", "2024-03-11 00:00:00", 1, "running", ""), ("k3", "2024-03-11 00:00:00", 2, "running", "")],
              "key string, pip_date ts, rider_id int, pip_status string, pip_result string").withColumn("pip_date", F.col("pip_date").cast("date"))
    out = finalise(close_week(df, "2024-03-06"))
    assert values(out, "key", "pip_status") == [("k1", "final"), ("k3", "running")]


def test_star_remarks_cover_all_sums():
    assert sorted(rules.STAR_REMARKS) == [0, 1, 2, 3, 4, 5]


def test_ageing_bounds(rows):
    df = rows([(1, "2024-05-01 23:00:00", "Picked-up", None, None), (2, "2024-05-02 00:00:00", "Picked-up", None, None), (3, "2024-04-01 00:00:00", "Lost", None, None),
               (4, "2024-04-01 00:00:00", "Failed Delivered", "2024-05-30 00:00:00", None), (5, "2024-04-01 00:00:00", "Failed Delivered", "2024-05-31 00:00:00", None)],
              "awb int, pickuptime ts, shipment_status string, delivertime ts, rto_delivered_time ts")
    assert values(service.ageing(df, "2024-05-31", "2024-05-01"), "awb", "age_interval") == [(1, 30), (5, 60)]


def test_ledger_has_one_row_per_trip(rows):
    trips = rows([(1, "a", 7, "COMPLETED", "2024-03-02 10:00:00", 50.0, True, False), (2, "b", 8, "COMPLETED", "2024-03-03 10:00:00", 60.0, False, False),
                  (3, "c", 9, "COMPLETED", "2024-03-03 10:00:00", 70.0, False, True), (4, "d", 7, "COMPLETED", "2023-01-01 10:00:00", 50.0, True, False)],
                 "trip_id int, awb string, shipment_id int, status string, dispatch_time ts, cod_amount double, is_collected boolean, is_realized boolean").withColumns({
                     "completed_at": F.col("dispatch_time"), "rider_id": F.lit(1), "rider_name": F.lit("r"), "hub_name": F.lit("h"), "shipping_city": F.lit("x"),
                     "reconciled_at": F.col("dispatch_time"), "collected_by": F.lit("a__b__c__d")})
    lines = rows([(7, 20.0, "cod_amount", 100), (7, 30.0, "cod_amount", None), (7, 9.0, "freight", 100), (9, 70.0, "cod_amount", 101), (9, 1.0, "cod_amount", 102)],
                 "shipment_id int, amount double, reference_type string, incoming_cash_flow_id int")
    flows = rows([(100, "2024-03-04 00:00:00"), (101, "2024-03-05 00:00:00"), (102, "2023-11-05 00:00:00")], "id int, created_time ts")
    for hot in ("auto", 1):
        out = cash.cod_ledger(trips, lines, flows, "2024-03-10", months=3, hot=hot)
        assert values(out, "trip_id", "amount", "collected", "deposited", "deposited_on") == [
            (1, 50.0, 1, 0, "2024-03-04"), (2, 60.0, 0, 0, None), (3, 71.0, 1, 1, "2024-03-05")]
    assert cash.cod_ledger(trips, lines, flows).count() == 4


def test_service_per_due_day_and_intake(rows):
    df = rows([("x", "a", "2024-01-01 00:00:00", 1, 1, "Delivered", 5.0, "2024-01-01 09:00:00", 4000.0), ("x", "b", "2024-01-01 00:00:00", 0, 1, "Lost", None, "2024-01-01 10:00:00", 100.0),
               ("x", "c", None, 1, 1, "Delivered", 3.0, None, 100.0)],
              "city string, awb string, pickup_date ts, otd int, ofd int, shipment_status string, rating double, datetime ts, chargeable_weight double")
    assert values(service.delivery_by_edd(df, ["city"]), "efd", "otd", "ofd", "delivered", "otd_ratio", "no_ratings", "avg_rating") == [(2, 1, 2, 1, 0.5, 1, 5.0)]
    assert values(service.intake_by_day(df, ["city"]), "datetime", "drr", "heavy_shipments") == [("2024-01-01 00:00:00", 2, 1)]


def test_rider_master_with_overrides(rows):
    riders = rows([(1, "a", 10, 5, "ORDER"), (2, "b", 11, 6, "FIXED")], "rider_id int, rider_name string, node_id int, vendor_id int, payout_structure string")
    nodes, vendors = rows([(10, "hub", "x")], "node_id int, node_name string, city string"), rows([(5, "v5"), (6, "v6")], "vendor_id int, vendor_name string")
    changes = rows([(2, "ORDER", None)], "rider_id int, payout_structure string, vendor_name string")
    assert values(pay.rider_info(riders, nodes, vendors, changes)) == [(1, "a", "hub", "x", "ORDER", "v5"), (2, "b", None, None, "ORDER", "v6")]
    assert values(pay.rider_info(riders, nodes, vendors), "payout_structure") == [("FIXED",), ("ORDER",)]


def test_margin_cuts_keep_no_table_of_orders(rows):
    """Orders of one combination are counted along their rows; only orders with several keep their id. Null ids, cities and copies."""
    data = [(i % 400, "Pune" if i % 2 else "Delhi", "c%d" % (i % 4), 1.25 * (i % 7), None if i % 5 == 0 else 0.5) for i in range(800)]
    data += [(7, "Pune", "other", 3.0, 1.0), (7, "Pune", "other", 3.0, 1.0), (8, None, "c0", 2.0, 1.0), (None, "Pune", "c1", 4.0, None), (None, "Pune", "c1", 4.0, None),
             (900, None, "c2", 5.0, 1.0), (901, "Delhi", None, 6.0, 2.0)]
    df = rows(data, "awb long, city string, client string, shipment_charges double, total_cost double")
    per = margin._per_combination(df, ["city", "client"], "shipment_charges", "total_cost")
    assert {r["_order"] for r in per.collect()} == {None, 7, 8}
    out = margin.margin_cuts(df, {"both": ["city", "client"], "city": ["city"]})
    for name, dims in (("both", ("city", "client")), ("city", ("city",))):
        want = {}
        for awb, city, client, r, c in data:
            if city is not None:
                group = want.setdefault((city, client)[:len(dims)], [set(), 0.0, 0.0])
                group[0].add(awb)
                group[1] += r
                group[2] += c or 0.0
        want = sorted(((*k, len(v[0] - {None}), round(v[1], 2), round(v[2], 2), round(v[1] - v[2], 2)) for k, v in want.items()), key=repr)
        columns = [*dims, "orders", "shipment_charges", "total_cost", "margin"]
        assert values(out.filter(F.col("cut") == name), *columns) == want
        assert values(margin.margin_by(df, list(dims)), *columns) == want
