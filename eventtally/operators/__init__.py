"""DataFrame-to-DataFrame operators. They take their input from no path and leave no table; lookups,
lateness and percentiles store and measure small intermediate tables while a frame is built."""
