"""Online-shopping behaviour analytics as lazy Spark plans.

Click events and sales targets are landed, checked, curated into a star schema,
segmented by recency / frequency / monetary value and turned into weekly demand,
price elasticity and sales forecasts.  Every public function takes DataFrames and
returns DataFrames; the run time is always an argument, never read from a clock.
"""
