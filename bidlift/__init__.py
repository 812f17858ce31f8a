"""bidlift: ad-bidding analytics on Spark DataFrames.

Logs come in as DataFrames, every operator takes and returns DataFrames, and
the ad id is a grouping key throughout, so one job serves all ads.
"""

__version__ = "0.1.0"
