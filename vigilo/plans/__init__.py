"""Table builds: silver cleaners, star-schema dimensions and facts, measures."""
