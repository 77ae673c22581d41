"""The analytics themselves: history, star schema, segmentation, demand and forecasts."""
