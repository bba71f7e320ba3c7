"""Small tables with answers checked by hand. Fixed values, in their natural order."""

from datetime import date, datetime

D = date.fromisoformat
TS = datetime.fromisoformat

ECOMMERCE_CUSTOMERS = """customer_id,name,email,country,signup_date,status
1,John Smith,john.smith@email.com,USA,2024-01-15,active
2,Maria Garcia,maria.garcia@email.com,Spain,2024-02-20,active
3,Li Wei,li.wei@email.com,China,2024-01-10,inactive
4,Sarah Johnson,sarah.j@email.com,USA,2024-03-05,active
5,Ahmed Hassan,ahmed.h@email.com,Egypt,2024-02-28,active
6,Emma Wilson,emma.w@email.com,UK,2024-01-25,active
7,Carlos Rodriguez,carlos.r@email.com,Mexico,2024-03-10,inactive
8,Yuki Tanaka,yuki.t@email.com,Japan,2024-02-15,active
9,Anna Mueller,anna.m@email.com,Germany,2024-01-30,active
10,Raj Patel,raj.p@email.com,India,2024-03-01,active
11,Invalid User,,USA,2024-01-01,active
12,Test User,test@test.com,,2024-02-01,active
"""

ECOMMERCE_ORDERS = """order_id,customer_id,product_name,quantity,price,order_date,status
1001,1,Laptop,1,999.99,2024-03-15,completed
1002,2,Mouse,2,25.50,2024-03-16,completed
1003,1,Keyboard,1,79.99,2024-03-17,completed
1004,3,Monitor,1,299.99,2024-03-18,cancelled
1005,4,Laptop,1,999.99,2024-03-19,completed
1006,5,Headphones,3,45.00,2024-03-20,completed
1007,6,USB Cable,5,12.99,2024-03-21,completed
1008,2,Webcam,1,89.99,2024-03-22,pending
1009,7,Mouse Pad,2,15.99,2024-03-23,completed
1010,8,Laptop,2,999.99,2024-03-24,completed
1011,9,Keyboard,1,79.99,2024-03-25,completed
1012,4,Monitor,2,299.99,2024-03-26,completed
1013,10,Headphones,1,45.00,2024-03-27,completed
1014,1,USB Cable,10,12.99,2024-03-28,completed
1015,11,Mouse,1,25.50,2024-03-29,completed
1016,999,Keyboard,1,79.99,2024-03-30,completed
1017,6,Laptop,1,999.99,2024-04-01,pending
1018,8,Monitor,1,299.99,2024-04-02,completed
"""

SPEND_ORDERS = [
    (1, 101, D("2025-01-10"), 250, "Electronics"),
    (2, 102, D("2025-02-15"), 180, "Fashion"),
    (3, 103, D("2025-02-17"), 70, "Groceries"),
    (4, 101, D("2025-03-01"), 300, "Electronics"),
    (5, 104, D("2025-03-12"), 120, "Health"),
]

SALES = [
    (1, "2024-01-15", "PROD001", "Electronics", 5, 299.99, "CUST001", "USA"),
    (2, "2024-01-15", "PROD002", "Clothing", 2, 49.99, "CUST002", "UK"),
    (3, "2024-01-16", "PROD001", "Electronics", 1, 299.99, "CUST003", "USA"),
    (4, "2024-01-16", "PROD003", "Books", 3, 15.99, "CUST001", "USA"),
    (5, "2024-01-17", "PROD002", "Clothing", 1, 49.99, "CUST004", "Canada"),
    (6, "2024-01-17", "PROD004", "Electronics", 2, 799.99, "CUST002", "UK"),
]

SERVER_DAYS = [
    (i + 1, D(f"2024-01-{i + 1:02d}"), "unhealthy" if i + 1 in (3, 9) else "healthy")
    for i in range(10)
]

STOCK = [
    (1, D("2024-01-02"), 145), (2, D("2024-01-03"), 155), (3, D("2024-01-04"), 160),
    (4, D("2024-01-05"), 142), (5, D("2024-01-08"), 158), (6, D("2024-01-09"), 162),
    (7, D("2024-01-10"), 170), (8, D("2024-01-11"), 175), (9, D("2024-01-12"), 140),
    (10, D("2024-01-15"), 152),
]

# server, hour of 2025-01-10 (or day at 10h for server 1), status, cpu
SERVERS = [
    (1, TS(f"2025-01-{d:02d} 10:00:00"), s, c)
    for d, s, c in [
        (1, "healthy", 45), (2, "healthy", 52), (3, "down", None), (4, "healthy", 38),
        (5, "healthy", 41), (6, "healthy", 55), (7, "healthy", 60), (8, "maintenance", None),
        (9, "healthy", 48),
    ]
] + [
    (server, TS(f"2025-01-10 {hour}:00:00"), s, c)
    for server, rows in {
        2: [(10, "healthy", 40), (11, "unstable", 95), (12, "unstable", 90), (13, "unstable", 94),
            (14, "unstable", 96), (15, "unstable", 97), (16, "unstable", 80), (17, "healthy", 45)],
        3: [(10, "unstable", 85), (11, "unstable", 92), (12, "unstable", 88), (13, "unstable", 91),
            (14, "unstable", 93), (15, "unstable", 94), (16, "unstable", 82), (17, "healthy", 32)],
        4: [(10, "healthy", 30), (11, "healthy", 35), (12, "down", None), (13, "unstable", 87),
            (14, "unstable", 89), (15, "unstable", 90), (16, "healthy", 41), (17, "healthy", 36)],
    }.items()
    for hour, s, c in rows
]

STORE_DAYS = [
    (101, D("2024-05-01"), 1000), (101, D("2024-05-02"), 1200), (101, D("2024-05-03"), 900),
    (101, D("2024-05-04"), 1500), (102, D("2024-05-01"), 800), (102, D("2024-05-02"), 1100),
    (102, D("2024-05-03"), 1300),
]
DIM_PRODUCT = [
    (1, "TEE-01", "Classic Crew", "100% Cotton", D("2023-01-01"), D("2024-01-01"), False),
    (2, "TEE-01", "Classic Crew", "Organic Cotton", D("2024-01-02"), D("9999-12-31"), True),
    (3, "JEAN-01", "Slim Fit", "Denim", D("2023-01-01"), D("9999-12-31"), True),
]
DIM_CUSTOMER = [(1, "Alice", "North"), (2, "Bob", "South"), (3, "Charlie", "North")]
FACT_SALES = [
    (1, 1, D("2023-06-15"), 2, 40), (2, 1, D("2024-02-20"), 1, 25), (3, 2, D("2024-03-01"), 1, 60),
]

LAKE_BATCH_1 = [
    ("O001", "C1", "Laptop", 1, 999.99, TS("2024-01-10")),
    ("O002", "C2", "Mouse", 2, 29.98, TS("2024-01-15")),
    ("O003", "C1", "Keyboard", 1, 79.99, TS("2024-02-05")),
    ("O004", "C3", "Monitor", 1, 399.0, TS("2024-02-20")),
    ("O005", "C2", "Headphones", 3, 149.97, TS("2024-03-01")),
]
LAKE_BATCH_2 = [
    ("O006", "C4", "Webcam", 1, 89.99, TS("2024-03-10")),
    ("O007", "C1", "USB Hub", 1, 49.99, TS("2024-03-22")),
    ("O008", "C5", "Desk Lamp", 2, 65.0, TS("2024-04-02")),
]
LAKE = "order_id string, customer_id string, product string, quantity int, total_usd float, order_ts timestamp_ntz"
