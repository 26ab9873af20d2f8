"""Models: cleaned layers, dimensions, facts, marts, features, pricing and measures."""
