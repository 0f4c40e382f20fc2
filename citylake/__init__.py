"""citylake: city analytics (trips, air quality, rates, GDP, weather) as Spark DataFrame operators."""
