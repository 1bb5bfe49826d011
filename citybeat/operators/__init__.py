"""DataFrame operators: each takes DataFrames and returns one.

common     zero-filled counts, shares, latest-per-group, top-k (W1-W4, W7, W8)
taxi       trip volumes, bins, fare parts, flags, zones, OD pairs (A1-A12, A30, B1, B3, J1-J3, P19)
bikes      bike-trip cleaning, flows, stations, member/type/duration counts (P1, P2, P6, P17, A13-A19, B2, R2)
traffic    traffic-count cleaning and volume profiles (P10-P14, A20-A26, R2)
ridership  mode x year means, totals, shares, featured years, stacked pivot (A27, A28, W5, W6, W9, R1, X2)
reports    report cell tables to tidy rows (S6, U1-U4)
polygons   point in polygon (J4)
leaf_index within distance and nearest (J5, J6)
spatial    route geometry, rings (J7, J8, G1, A29)
network    travel times, subgraphs, bounded shortest paths, coverage, routes (G2-G7)
sampling   systematic per-group sample (W10)
grid       zero-filled category x series grid (R3)
"""
