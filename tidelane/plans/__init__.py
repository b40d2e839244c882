from tidelane.plans.underway import (
    clean_and_raw_means,
    combine_underway,
    flag_flow,
    flag_ph,
    flagged_minute_means,
    patch_gps,
    patch_tsg,
    prepare_feeds,
    process_underway,
    read_ph_and_flag,
    read_rho,
    store_feeds,
)
