"""lotflow: occupancy and fee analytics over sightings of vehicles at slots, on PySpark."""
