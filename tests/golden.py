"""The published 20-product snapshot (needed columns) and its report tables."""

COLUMNS = (
    "asin string, product_byline string, price double, product_price double, product_original_price double, "
    "product_star_rating double, product_num_ratings bigint, sales_volume_num double, rating_balance double, "
    "segment_kmeans string"
)

ROWS = [
    ("P00", "Visit the JBL Store", 39.95, 39.95, 49.95, 4.5, 89869, 7000.0, 0.73, "Cluster 1"),
    ("P01", "Visit the JBL Store", 39.95, 39.95, 49.95, 4.5, 89869, 5000.0, 0.73, "Cluster 1"),
    ("P02", "Visit the KVIDIO Store", 24.56, 18.97, 24.56, 4.5, 32277, 10000.0, 0.71, "Cluster 1"),
    ("P03", "Visit the BERIBES Store", 39.41, 19.97, 28.99, 4.5, 52207, 10000.0, 0.71, "Cluster 1"),
    ("P04", "Visit the JBL Store", 29.95, 29.95, 49.95, 4.3, 35729, 10000.0, 0.61, "Cluster 1"),
    ("P05", "Visit the Sony Store", 98.00, 66.00, 179.99, 4.4, 14652, 7000.0, 0.66, "Cluster 1"),
    ("P06", "Visit the Sony Store", 48.00, 48.00, 69.99, 4.5, 30503, 2000.0, 0.70, "Cluster 1"),
    ("P07", "Visit the Soundcore Store", 30.80, 19.99, 39.99, 4.4, 98070, 10000.0, 0.67, "Cluster 1"),
    ("P08", "Visit the Soundcore Store", 44.99, 39.99, 69.99, 4.6, 56500, 10000.0, 0.75, "Cluster 1"),
    ("P09", "Visit the Beats Store", 169.95, 169.95, 349.99, 4.5, 26233, 10000.0, 0.74, "Cluster 1"),
    ("P10", "Visit the Picun Store", 67.92, 17.98, 29.99, 4.6, 11597, 8000.0, 0.74, "Cluster 1"),
    ("P11", "Visit the Soundcore Store", 39.99, 29.99, 49.99, 4.4, 27649, 6000.0, 0.66, "Cluster 1"),
    ("P12", "Visit the JBL Store", 99.95, 99.95, 149.95, 4.5, 4557, 3000.0, 0.73, "Cluster 1"),
    ("P13", "Visit the JBL Store", 59.95, 59.95, 89.95, 4.5, 12118, 10000.0, 0.74, "Cluster 1"),
    ("P14", "Visit the Beats Store", 129.95, 129.95, 199.95, 4.6, 24361, 9000.0, 0.79, "Cluster 1"),
    ("P15", "Visit the Beats Store", 129.95, 129.95, 199.95, 4.6, 24361, 9000.0, 0.79, "Cluster 1"),
    ("P16", "Visit the Apple Store", 99.00, 99.00, 129.00, 4.5, 43718, 10000.0, 0.74, "Cluster 1"),
    ("P17", "Visit the JBL Store", 39.95, 39.95, 64.95, 4.2, 3845, 10000.0, 0.57, "Cluster 1"),
    ("P18", "Visit the Apple Store", 224.00, 224.00, 249.00, 4.4, 6801, 10000.0, 0.71, "Cluster 1"),
    ("P19", "Visit the Sennheiser Store", 279.95, 279.95, None, 4.4, 39, None, 0.65, "Cluster 2"),
]


def rows():
    return ROWS


BANDS = {
    "economy": (8, 35.57, 24.56, 39.99),
    "mid": (7, 73.97, 44.99, 99.95),
    "premium": (5, 186.76, 129.95, 279.95),
}
BRANDS = {
    "JBL": (45000, 28.85),
    "Beats": (28000, 17.95),
    "Soundcore": (26000, 16.67),
    "Apple": (20000, 12.82),
    "BERIBES": (10000, 6.41),
    "KVIDIO": (10000, 6.41),
    "Sony": (9000, 5.77),
    "Picun": (8000, 5.13),
    "Sennheiser": (0, 0.0),
}
CORRELATIONS = {
    ("price", "product_star_rating"): 0.03,
    ("price", "sales_volume_num"): 0.141,
    ("product_star_rating", "sales_volume_num"): -0.124,
}
PROFILE = {
    "Cluster 1": (19, 69.65, 4.47, 34.82, 0.71, 36048.21, 8210.53),
    "Cluster 2": (1, 279.95, 4.4, None, 0.65, 39.0, None),
}
