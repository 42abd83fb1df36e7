"""tidepool: Spark-native analytics for concentrated-liquidity pool event logs.

Raw chain logs are read as tables or file streams, deduplicated, given block
times, decoded into Swap / Mint / Burn / Collect events with exact 256-bit
integers, and aggregated per pool and tumbling window into counts, volumes,
fees, balances, fee rates and an annualised rate.  Everything is expressed as
DataFrame / SQL operations so that Catalyst plans the work.
"""

__version__ = "0.1.0"
