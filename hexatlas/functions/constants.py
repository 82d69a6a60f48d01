"""Fixed values of the published icosahedral, aperture-7 hexagon grid.

Nothing here is computed: these numbers define the grid, and every id and
coordinate depends on them.  Everything that can be worked out from them (face
adjacency, base-cell neighbours, rotations, ...) is derived in ``tables.py``.
"""

# Centre of each icosahedron face, (latitude, longitude) in radians.
FACE_CENTERS = [
    (0.803582649718989942, 1.248397419617396099),
    (1.307747883455638156, 2.536945009877921159),
    (1.054751253523952054, -1.347517358900396623),
    (0.600191595538186799, -0.450603909469755746),
    (0.491715428198773866, 0.401988202911306943),
    (0.172745327415618701, 1.678146885280433686),
    (0.605929321571350690, 2.953923329812411617),
    (0.427370518328979641, -1.888876200336285401),
    (-0.079066118549212831, -0.733429513380867741),
    (-0.230961644455383637, 0.506495587332349035),
    (0.079066118549212831, 2.408163140208925497),
    (0.230961644455383637, -2.635097066257444203),
    (-0.172745327415618701, -1.463445768309359553),
    (-0.605929321571350690, -0.187669323777381622),
    (-0.427370518328979641, 1.252716453253507838),
    (-0.600191595538186799, 2.690988744120037492),
    (-0.491715428198773866, -2.739604450678486295),
    (-0.803582649718989942, -1.893195233972397139),
    (-1.307747883455638156, -0.604647643711872080),
    (-1.054751253523952054, 1.794075294689396615),
]

# Azimuth (radians, clockwise from north) of each face's i axis.
FACE_AXIS_AZIMUTH = [
    5.619958268523939882,
    5.760339081714187279,
    0.780213654393430055,
    0.430469363979999913,
    6.130269123335111400,
    2.692877706530642877,
    2.982963003477243874,
    3.532912002790141181,
    3.494305004259568154,
    3.003214169499538391,
    5.930472956509811562,
    0.138378484090254847,
    0.448714947059150361,
    0.158629650112549365,
    5.891865957979238535,
    2.711123289609793325,
    3.294508837434268316,
    3.804819692245439833,
    3.664438879055192436,
    2.361378999196363184,
]

# The home face of base cells 0-121, which fixes the orientation
# of their digits.
HOME_FACE = [
    1, 2, 1, 2, 0, 1, 1, 2, 0, 2,
    1, 1, 3, 3, 11, 4, 0, 6, 0, 2,
    7, 2, 0, 6, 10, 6, 3, 11, 4, 3,
    0, 4, 5, 0, 7, 11, 7, 10, 12, 6,
    7, 4, 3, 3, 4, 6, 11, 8, 5, 14,
    5, 12, 10, 4, 12, 7, 11, 10, 13, 10,
    11, 9, 8, 6, 8, 9, 14, 5, 16, 8,
    5, 12, 7, 12, 10, 9, 13, 16, 15, 15,
    16, 14, 13, 5, 8, 14, 9, 14, 17, 12,
    16, 17, 15, 16, 9, 15, 13, 8, 13, 17,
    19, 14, 19, 17, 13, 17, 16, 9, 15, 15,
    18, 18, 19, 17, 19, 18, 18, 19, 19, 18,
    19, 18,
]

# Fixed value: gnomonic length of one resolution-0 unit at a face centre.
RES0_UNIT = 0.38196601125010500003

# Fixed value: authalic earth radius in kilometres.
EARTH_RADIUS_KM = 6371.007180918475

MAX_RES = 15
NUM_BASE_CELLS = 122

# Names of the containment rules and what each stands for.
CONTAINMENT_MODES = {
    "CONTAINMENT_CENTER": "center",
    "center": "center",
    "CONTAINMENT_FULL": "full",
    "full": "full",
    "CONTAINMENT_OVERLAPPING": "overlap",
    "overlap": "overlap",
    "CONTAINMENT_OVERLAPPING_BBOX": "overlap_bbox",
    "overlap_bbox": "overlap_bbox",
}

# Published average hexagon edge length per resolution 0-15, in kilometres.
EDGE_LENGTH_AVG_KM = [
    1281.256011, 483.0568391, 182.5129565, 68.97922179,
    26.07175968, 9.854090990, 3.724532667, 1.406475763,
    0.531414010, 0.200786148, 0.075863783, 0.028663897,
    0.010830188, 0.004092010, 0.001546100, 0.000584169,
]
