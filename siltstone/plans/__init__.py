"""Recipes composed of the operators: silver entities, the star schema, cleaning, whole runs."""
