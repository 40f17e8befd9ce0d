from sparkmine.functions.columns import (  # noqa: F401
    bitstring_phase,
    bitstring_value,
    is_subset,
    drop_one_subsets,
    euclidean_distance,
    itemset_string,
    min_count_from_support,
    race_key,
    seeded_hash,
    seeded_uniform,
    squared_distance,
)
