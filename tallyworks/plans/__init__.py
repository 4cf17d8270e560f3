"""Ready-made analyses over logical tables, composed of the operators."""
