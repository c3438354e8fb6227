"""DataFrame-in, DataFrame-out operators.

clean       P1-P24 cleaning rules and the configurable cleaning chain
profile     W1, W2, W6 window / column profiles (salted two-stage option)
metrics     A1-A13 counts, classification metrics, exact ROC / PR AUC, gate
drift       W3-W5 KS, PSI / JS / chi-square, window over window
sampling    D1-D4 exact and hash splits, exact resampling, top-n
features    M1-M3, M9 category dictionaries, feature assembly, contracts
model       M4-M5 boosted-tree training, batch and foreign-model scoring
experiment  M6-M8 A/B routing, routed scoring, read-out
payload     J1-J7, P17-P20 JSON parsing, flattening, payload building
synth       G1-G7 distribution-matched synthetic tables
runs        R1-R8 run-log queries
"""
