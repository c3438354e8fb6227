"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  ``queries`` registers
the contract queries; every other module is one operator with its own
general interface:

urlfilter   blocked Bloom filter + exact hash join over listed URLs
mixing      Pareto order sampling to target source weights
ann         inverted lists searched by an adaptive dimension scan
vecdedup    hyperplane sign tables + exact cosine + connected components
sitetree    main text of HTML pages from per-host style trees
toxicity    linear-chain CRF over toxic spans
simhash     SimHash near-duplicates through Golay-code keys
licenses    license notices by patience alignment
spdropout   piece encoding with seeded merge dropout, lossless decoding
langid      byte convolutional network
topk        exact inner-product search, a ball tree in every shard
resampling  importance resampling towards a target, bit-sliced weights
merkle      dataset manifest, subtrees in a van Emde Boas layout
"""
