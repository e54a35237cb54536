"""The sample banking dataset (8 customers, 10 accounts, 6 merchants, 21
transactions) as DataFrames; timestamps are written with their +05:45 offset
and parsed by Spark into instants."""

from pyspark.sql import functions as F

CUSTOMERS = [
    (1, "Aarav Shrestha", "aarav@example.com", "Kathmandu", "2025-11-10 09:00:00+05:45", ["vip", "salary"]),
    (2, "Nisha Karki", "nisha@example.com", "Lalitpur", "2025-10-02 10:20:00+05:45", ["student"]),
    (3, "Rohit Gurung", "rohit@example.com", "Pokhara", "2025-09-18 14:10:00+05:45", ["travel"]),
    (4, "Sita Rai", "sita@example.com", "Biratnagar", "2025-12-01 08:15:00+05:45", ["vip", "risk_high"]),
    (5, "Bikash Thapa", "bikash@example.com", "Kathmandu", "2025-08-21 16:45:00+05:45", []),
    (6, "Anu Poudel", "anu@example.com", "Lalitpur", "2025-07-11 11:05:00+05:45", ["salary"]),
    (7, "Prakash Adhikari", "prakash@example.com", "Pokhara", "2025-12-15 12:00:00+05:45", ["vip"]),
    (8, "Mina Sharma", "mina@example.com", "Kathmandu", "2025-06-30 09:30:00+05:45", ["student", "travel"]),
]

ACCOUNTS = [
    (1, 1, "checking", "2025-11-12 09:00:00+05:45", "active"),
    (2, 1, "savings", "2025-11-12 09:05:00+05:45", "active"),
    (3, 2, "checking", "2025-10-03 10:00:00+05:45", "active"),
    (4, 3, "credit", "2025-09-20 12:00:00+05:45", "active"),
    (5, 4, "checking", "2025-12-02 09:00:00+05:45", "frozen"),
    (6, 5, "checking", "2025-08-22 10:00:00+05:45", "active"),
    (7, 6, "savings", "2025-07-12 11:00:00+05:45", "active"),
    (8, 7, "checking", "2025-12-16 09:00:00+05:45", "active"),
    (9, 8, "credit", "2025-07-01 10:00:00+05:45", "active"),
    (10, 8, "checking", "2025-07-01 10:10:00+05:45", "active"),
]

MERCHANTS = [
    (1, "Himal Mart", "5411", "Kathmandu"),
    (2, "QuickFuel", "5541", "Lalitpur"),
    (3, "Skyline Hotel", "7011", "Pokhara"),
    (4, "Mero Online", "5964", "Kathmandu"),
    (5, "City Pharmacy", "5912", "Biratnagar"),
    (6, "TravelHub", "4722", "Kathmandu"),
]


def _m(channel, device, ip, extra=""):
    return '{"channel":"%s","device_id":"%s","ip":"%s"%s}' % (channel, device, ip, extra)


TRANSACTIONS = [
    (1, 1, 1, "2026-01-01 09:10:00+05:45", "2500.00", "posted", _m("pos", "DVC-101", "103.10.28.1", ',"note":"groceries"')),
    (2, 1, 4, "2026-01-01 22:40:00+05:45", "7999.00", "posted", _m("web", "DVC-101", "103.10.28.1", ',"note":"online purchase"')),
    (3, 1, 2, "2026-01-02 07:35:00+05:45", "2000.00", "posted", _m("pos", "DVC-102", "103.10.28.5", ',"note":"fuel"')),
    (4, 2, 6, "2026-01-02 18:20:00+05:45", "12000.00", "posted", _m("mobile", "DVC-201", "27.34.12.9", ',"note":"ticket booking"')),
    (5, 2, 6, "2026-01-03 08:15:00+05:45", "9000.00", "reversed", _m("mobile", "DVC-201", "27.34.12.9", ',"note":"reversal"')),
    (6, 3, 1, "2026-01-01 12:00:00+05:45", "1500.00", "posted", _m("pos", "DVC-301", "110.44.120.8")),
    (7, 3, 4, "2026-01-02 21:05:00+05:45", "4999.00", "posted", _m("web", "DVC-301", "110.44.120.8")),
    (8, 3, 4, "2026-01-03 21:10:00+05:45", "5999.00", "declined", _m("web", "DVC-999", "185.17.22.3", ',"reason":"insufficient_funds"')),
    (9, 4, 3, "2026-01-02 20:00:00+05:45", "18000.00", "posted", _m("pos", "DVC-401", "202.51.74.10", ',"note":"hotel"')),
    (10, 4, 3, "2026-01-04 08:30:00+05:45", "22000.00", "posted", _m("pos", "DVC-401", "202.51.74.10", ',"note":"hotel"')),
    (11, 4, 6, "2026-01-04 09:10:00+05:45", "35000.00", "posted", _m("mobile", "DVC-402", "202.51.74.99", ',"note":"travel booking"')),
    (12, 5, 5, "2026-01-02 10:00:00+05:45", "1200.00", "posted", _m("pos", "DVC-501", "36.252.10.2", ',"note":"pharmacy"')),
    (13, 5, 5, "2026-01-02 10:05:00+05:45", "1300.00", "posted", _m("pos", "DVC-501", "36.252.10.2", ',"note":"pharmacy"')),
    (14, 5, 5, "2026-01-02 10:08:00+05:45", "1250.00", "posted", _m("pos", "DVC-501", "36.252.10.2", ',"note":"pharmacy"')),
    (15, 6, 1, "2026-01-03 09:00:00+05:45", "2600.00", "posted", _m("pos", "DVC-601", "103.1.92.77")),
    (16, 6, 2, "2026-01-03 09:30:00+05:45", "2100.00", "posted", _m("pos", "DVC-601", "103.1.92.77")),
    (17, 7, 4, "2026-01-04 23:50:00+05:45", "15000.00", "posted", _m("web", "DVC-777", "185.17.22.3", ',"note":"late-night purchase"')),
    (18, 7, 4, "2026-01-05 00:05:00+05:45", "14000.00", "posted", _m("web", "DVC-777", "185.17.22.3", ',"note":"late-night purchase"')),
    (19, 8, 6, "2026-01-03 16:40:00+05:45", "8000.00", "posted", _m("mobile", "DVC-801", "49.244.88.19")),
    (20, 9, 2, "2026-01-04 07:20:00+05:45", "1900.00", "posted", _m("pos", "DVC-802", "49.244.88.19")),
    (21, 10, 1, "2026-01-04 19:10:00+05:45", "3100.00", "posted", _m("pos", "DVC-802", "49.244.88.19")),
]


def banking_tables(spark):
    c = spark.createDataFrame(
        CUSTOMERS, "customer_id int, full_name string, email string, city string, created_at string, tags array<string>"
    ).withColumn("created_at", F.col("created_at").cast("timestamp"))
    a = spark.createDataFrame(
        ACCOUNTS, "account_id int, customer_id int, account_type string, opened_at string, status string"
    ).withColumn("opened_at", F.col("opened_at").cast("timestamp"))
    m = spark.createDataFrame(MERCHANTS, "merchant_id int, merchant_name string, mcc string, city string")
    t = spark.createDataFrame(
        TRANSACTIONS,
        "transaction_id bigint, account_id int, merchant_id int, ts_event string, amount string, "
        "status string, metadata string",
    ).select(
        "transaction_id", "account_id", "merchant_id",
        F.col("ts_event").cast("timestamp").alias("ts_event"),
        F.col("amount").cast("decimal(12,2)").alias("amount"),
        F.lit("NPR").alias("currency"), "status", "metadata",
    )
    return {"customers": c, "accounts": a, "merchants": m, "transactions": t}
