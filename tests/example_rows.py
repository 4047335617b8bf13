"""The example log of the tests."""

# The 20 example actions, in file order.
PURCHASES = ["u1 iphone", "u1 ipad", "u2 nexus", "u2 galaxy", "u3 surface", "u4 iphone", "u4 galaxy"]
VIEWS = [
    "u1 iphone", "u1 ipad", "u1 nexus", "u1 galaxy", "u2 iphone", "u2 ipad", "u2 nexus",
    "u2 galaxy", "u3 surface", "u3 nexus", "u4 iphone", "u4 ipad", "u4 galaxy",
]
ACTIONS = [
    (user, action, item)
    for action, rows in (("purchase", PURCHASES), ("view", VIEWS))
    for user, item in (row.split() for row in rows)
]
